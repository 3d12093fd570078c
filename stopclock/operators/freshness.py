"""Feed freshness: counts of the last minutes, lag and a status."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopclock import schemas as S
from stopclock.functions.times import elapsed_s, instant, minus
from stopclock.operators.events import latest_per_key, since, until

When = Column | datetime | str


def status_from_lag(
    feed_key: Column,
    lag_s: Column,
    thresholds: Mapping[str, tuple[int, int, int]] = S.FRESHNESS_THRESHOLDS,
) -> Column:
    """healthy, lagging, stale or down; no lag means down.  Feeds without thresholds of
    their own get the default ones."""

    def grade(limits: tuple[int, int, int]) -> Column:
        healthy, lagging, stale = limits
        return (
            F.when(lag_s.isNull(), "down")
            .when(lag_s <= healthy, "healthy")
            .when(lag_s <= lagging, "lagging")
            .when(lag_s <= stale, "stale")
            .otherwise("down")
        )

    status = None
    for key, limits in thresholds.items():
        match = feed_key == key
        status = F.when(match, grade(limits)) if status is None else status.when(match, grade(limits))
    default = grade(S.DEFAULT_THRESHOLDS)
    return default if status is None else status.otherwise(default)


def _measures(ts: Column, now: Column, windows: tuple[float, float]) -> list[Column]:
    short, long = windows
    return [
        F.max(ts).alias("last_record_at"),
        F.count_if(ts > minus(now, minutes=short)).alias("record_count_5min"),
        F.count_if(ts > minus(now, minutes=long)).alias("record_count_1h"),
    ]


def _graded(df: DataFrame, now: Column) -> DataFrame:
    return (
        df.withColumn("snapshot_at", now)
        .withColumn("lag_seconds", elapsed_s(now, F.col("last_record_at")).cast("int"))
        .withColumn("status", status_from_lag(F.col("feed_key"), F.col("lag_seconds")))
        .select(*S.FRESHNESS.columns)
    )


def freshness(
    df: DataFrame,
    feed_key: str,
    as_of: When,
    ts_col: str = "received_at",
    agency_id: str | None = S.DEFAULT_AGENCY_ID,
    windows: tuple[float, float] = (5, 60),
) -> DataFrame:
    """One snapshot row for a feed, also where the feed has no rows at all.

    Rows after ``as_of`` do not count, so the lag is never negative.
    """
    now = instant(as_of)
    if agency_id is not None:
        df = df.filter(F.col("agency_id") == agency_id)
    row = until(df, ts_col, now).agg(*_measures(F.col(ts_col), now, windows))
    return _graded(row.withColumn("feed_key", F.lit(feed_key)), now)


def freshness_by(
    df: DataFrame,
    feed_col: str,
    as_of: When,
    ts_col: str = "received_at",
    windows: tuple[float, float] = (5, 60),
) -> DataFrame:
    """One snapshot row per feed of a table that holds several, in one pass."""
    now = instant(as_of)
    rows = (
        until(df, ts_col, now)
        .groupBy(F.col(feed_col).alias("feed_key"))
        .agg(*_measures(F.col(ts_col), now, windows))
    )
    return _graded(rows, now)


def latest_freshness(history: DataFrame) -> DataFrame:
    """Newest snapshot per feed."""
    return latest_per_key(history, ["feed_key"], [F.col("snapshot_at").desc()]).select(
        "feed_key",
        "last_record_at",
        "record_count_5min",
        "record_count_1h",
        "lag_seconds",
        "status",
    )


def freshness_trend(history: DataFrame, feed_key: str, as_of: When, hours: int = 24) -> DataFrame:
    """Snapshots of one feed over the last hours, newest first."""
    now = instant(as_of)
    rows = since(history, "snapshot_at", minus(now, hours=hours), False)
    return (
        until(rows, "snapshot_at", now)
        .filter(F.col("feed_key") == feed_key)
        .orderBy(F.col("snapshot_at").desc())
    )
