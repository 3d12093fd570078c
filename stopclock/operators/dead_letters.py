"""Rows for the failure table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopclock import schemas as S
from stopclock.functions.text import payload_cut, payload_head, sha256, short_message


def dead_letter(
    bad: DataFrame,
    feed_key: Column | str,
    error_class: Column,
    error_message: Column,
    payload: Column,
    occurred_at: Column,
    whole: bool = False,
    digest: Column | None = None,
) -> DataFrame:
    """Failure rows with a shortened message and the head of the payload.

    The id is a hash of the content, so a repeated run gives the same rows; the payload
    enters it whole.  ``whole`` stores all of the payload: for rows that exist nowhere else.
    ``digest`` is the hash of the whole payload where ``payload`` is only its beginning.
    """
    feed = F.lit(feed_key) if isinstance(feed_key, str) else feed_key
    body = payload.cast("binary")
    identity = F.concat_ws(
        "|",
        feed,
        error_class,
        F.unix_micros(occurred_at).cast("string"),
        F.coalesce(error_message, F.lit("")),
        sha256(F.coalesce(body, F.lit("").cast("binary"))) if digest is None else digest,
    )
    return bad.select(
        sha256(identity).alias("failure_id"),
        occurred_at.alias("occurred_at"),
        feed.alias("feed_key"),
        error_class.alias("error_class"),
        short_message(error_message).alias("error_message"),
        (body if whole else payload_head(body)).alias("sample_payload"),
        (F.lit(False) if whole else payload_cut(body)).alias("sample_payload_truncated"),
        F.lit(0).alias("retry_count"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
    ).select(*S.FAILURES.columns)


def unresolved_failures(failures: DataFrame) -> DataFrame:
    """Open failures, newest first."""
    return failures.filter(F.col("resolved_at").isNull()).orderBy(
        F.col("occurred_at").desc(), "failure_id"
    )
