"""Rolling record counts per feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rolling_counts(
    rows: DataFrame,
    feed_col: str = "feed_key",
    ts_col: str = "received_at",
    length: str = "5 minutes",
    step: str = "1 minute",
    delay: str = "1 minute",
) -> DataFrame:
    """Per feed and window of ``length`` ending every ``step``: rows and newest time.

    Works on a stream and on a table alike.  The status of a feed also needs the clock when
    nothing arrives, so it comes from the batch check.
    """
    return (
        rows.withWatermark(ts_col, delay)
        .groupBy(F.col(feed_col).alias("feed_key"), F.window(ts_col, length, step).alias("w"))
        .agg(F.count("*").alias("record_count"), F.max(ts_col).alias("last_record_at"))
        .select(
            "feed_key",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "record_count",
            "last_record_at",
        )
    )
