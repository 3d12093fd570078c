"""Continuous ingest: poll files to event rows, signatures and dead letters.

Each micro-batch runs the same functions as a batch job.  Appends skip known keys and
merges go by key, so a batch that is run again after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import partial
from hashlib import md5

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stopclock import schemas as S
from stopclock.functions.times import utc_day
from stopclock.operators.dead_letters import dead_letter
from stopclock.operators.feed_rows import (
    service_alert_rows,
    split_on_key,
    trip_update_rows,
    vehicle_position_rows,
)
from stopclock.operators.merges import upsert_keep_first, upsert_signature
from stopclock.operators.signatures import as_observations, field_signature
from stopclock.plans.buckets import merge_buckets
from stopclock.plans.runs import logged_run
from stopclock.plans.tables import append_all, append_counted, append_events, merge_keyed, read_events
from stopclock.functions.text import sha256
from stopclock.sources.feeds import exact_path, parse_feed_json, poll_file_stream, scan_feed_snapshots

FEEDS = {
    "vehicle_positions": (S.VEHICLE_POSITIONS, vehicle_position_rows),
    "trip_updates": (S.TRIP_UPDATES, trip_update_rows),
    "service_alerts": (S.SERVICE_ALERTS, partial(service_alert_rows, keep_position=True)),
}


#: What tells one poll of a feed from another: two polls of one second differ in content.
POLL = ("received_at", "payload_hash")


def unseen_polls(
    spark: SparkSession, root: str, polls: DataFrame, feed_key: str, days: list[date]
) -> DataFrame:
    """The pieces, each once, of each poll that the ledger of landed polls does not have yet.

    The ledger is read for ``days``, those of the batch, only.
    """
    once = polls.dropDuplicates([*POLL, "piece"])
    ledger = read_events(spark, root, S.LANDED_POLLS)
    ledger = ledger.filter(F.col("dt").isin(days) & (F.col("feed_key") == feed_key)) if days else ledger.limit(0)
    return once.join(ledger.select(*POLL), list(POLL), "left_anti")


def ingest_polls(
    spark: SparkSession,
    polls: DataFrame,
    root: str,
    feed: str,
    agency_id: str = S.DEFAULT_AGENCY_ID,
    token: str | None = None,
) -> None:
    """Land a set of polls of one feed: rows, signatures, dead letters; and log the run.

    A poll counts once, however often and under whatever name its file is landed.  ``token``
    names the set, so that signatures count once as well if it is cut off and landed again.

    Of polls as the scan gives them, in pieces, the texts are kept and parsed when rows are
    made of them; a poll whose entities were made of something else keeps those.
    """
    scanned = "piece" in polls.columns
    if scanned:
        polls = polls.drop("header", "entity")
    else:
        polls = polls.withColumns({"piece": F.lit(0), "pieces": F.lit(1), "length": F.octet_length("content")})
    feed_key = f"{agency_id}.{feed}"
    with logged_run(spark, root, feed_key, token) as run:
        polls = polls.withColumn("payload_hash", F.coalesce("payload_hash", F.lit("")))
        polls = polls.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            days, run.bytes_processed = polls.agg(
                F.collect_set(utc_day("received_at")),
                F.coalesce(F.sum("length"), F.lit(0)),
            ).first()
            new = unseen_polls(spark, root, polls, feed_key, days).persist(StorageLevel.MEMORY_AND_DISK)
            judged = _whole_polls(spark, new)
            judged = parse_feed_json(judged) if scanned else judged
            run.records_written = _land(spark, judged, root, feed, agency_id, token)
            # The ledger comes last: what is cut off before it is landed again.
            landed = new.filter("piece = 0").select(F.lit(feed_key).alias("feed_key"), *POLL, "path", F.lit(token).alias("token"))
            append_all(landed, root, S.LANDED_POLLS)
            new.unpersist()
        finally:
            polls.unpersist()


def _whole_polls(spark: SparkSession, polls: DataFrame) -> DataFrame:
    """Polls of which no piece is taken where one is rejected."""
    refused = polls.filter("pieces > 1 AND reject_reason IS NOT NULL")
    reasons = refused.groupBy(*POLL).agg(F.max("reject_reason").alias("_reason")).collect()  # a few large polls
    if not reasons:
        return polls
    known = spark.createDataFrame(reasons, "received_at timestamp, payload_hash string, _reason string")
    judged = polls.join(known, list(POLL), "left")
    return judged.withColumn("reject_reason", F.coalesce("_reason", "reject_reason")).select(*polls.columns)


def _land(
    spark: SparkSession, polls: DataFrame, root: str, feed: str, agency_id: str, token: str | None
) -> int:
    table, to_rows = FEEDS[feed]
    feed_key = f"{agency_id}.{feed}"
    good = polls.filter(F.col("reject_reason").isNull())
    rows = to_rows(good, agency_id=agency_id)
    whole, unkeyed = split_on_key(rows, table.key)
    if feed == "service_alerts":
        merge = partial(
            upsert_keep_first,
            keys=table.key,
            order=("last_seen_at", "position"),
            newer="last_seen_at",
        )
        merge_buckets(spark, root, table, whole, merge, token)
        written = whole.count()
        filled = None
    else:
        written = append_counted(spark, root, table, whole)
        # A poll of these feeds without rows records no signature.
        filled = rows.select("received_at", F.col("raw_payload_hash").alias("payload_hash")).distinct()
    by = ("feed_key", *POLL)
    # Signatures, not texts, meet the polls with rows: pieces of a poll stay in many tasks.
    signed = field_signature(good.withColumn("feed_key", F.lit(feed_key)), by)
    if filled is not None:
        signed = signed.join(filled, list(POLL), "left_semi")
    observed = as_observations(signed)
    merge_keyed(spark, root, S.SIGNATURES, observed, upsert_signature, part=feed, token=token)
    append_events(spark, root, S.FAILURES, _rejects(polls, unkeyed, feed_key), ts_col="occurred_at")
    return written


def _rejects(polls: DataFrame, unkeyed: DataFrame, feed_key: str) -> DataFrame:
    bad = polls.filter(F.col("reject_reason").isNotNull() & (F.col("piece") == 0))
    body = F.coalesce(F.col("content").cast("binary"), F.lit("").cast("binary"))
    files = dead_letter(
        bad,
        feed_key,
        F.col("reject_reason"),
        F.concat(F.lit("rejected file "), F.col("path")),
        F.col("content"),
        F.col("received_at"),
        digest=F.when(F.col("pieces") > 1, F.col("payload_hash")).otherwise(sha256(body)),
    )
    seen = "last_seen_at" if "last_seen_at" in unkeyed.columns else "received_at"
    rows = dead_letter(
        unkeyed,
        feed_key,
        F.lit("incomplete_key"),
        F.lit("a key column is not set"),
        F.to_json(F.struct(*unkeyed.columns)),
        F.col(seen),
        whole=True,
    )
    return files.unionByName(rows)


def ingest_stream(
    spark: SparkSession,
    landing: str,
    root: str,
    feed: str,
    checkpoint: str,
    agency_id: str = S.DEFAULT_AGENCY_ID,
    trigger: dict | None = None,
    pattern: str = "*.json",
    max_files: int | None = None,
) -> StreamingQuery:
    """Start the ingest of a landing folder, ``max_files`` at a time.  The default trigger
    takes what is there and stops; ``{"processingTime": "1 minute"}`` goes on (five minutes
    suit alerts)."""
    files = poll_file_stream(spark, landing, pattern, max_files)
    stream_id = md5(checkpoint.encode()).hexdigest()[:8]

    def land(batch: DataFrame, batch_id: int) -> None:
        token = f"{stream_id}.{batch_id}"
        paths = [exact_path(r["path"]) for r in batch.collect()]  # the files of a micro-batch
        if paths:
            polls = scan_feed_snapshots(batch.sparkSession, paths, pattern="*")
            ingest_polls(batch.sparkSession, polls, root, feed, agency_id, token)

    return (
        files.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def first_per_key(
    rows: DataFrame, keys: Sequence[str], ts_col: str = "received_at", delay: str = "1 hour"
) -> DataFrame:
    """Stream without repeats of a key; state is kept for the length of ``delay`` only."""
    return rows.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(keys))


def on_time(rows: DataFrame, ts_col: str, delay: str = "1 minute") -> DataFrame:
    """Stream with a watermark; rows later than ``delay`` fall out of its windows."""
    return rows.withWatermark(ts_col, delay)

