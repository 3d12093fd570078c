"""Queries over the event tables: recent rows, latest row per key, daily counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopclock.functions.times import day_text, instant, minus, utc_day

When = Column | datetime | str

POSITION_COLUMNS = (
    "vehicle_id",
    "trip_id",
    "route_id",
    "direction_id",
    "latitude",
    "longitude",
    "bearing",
    "speed_mps",
    "received_at",
)


def since(df: DataFrame, ts_col: str, start: Column, inclusive: bool) -> DataFrame:
    """Rows from ``start`` on; the day column, where there is one, is bounded as well."""
    if "dt" in df.columns:
        df = df.filter(F.col("dt") >= utc_day(start))
    ts = F.col(ts_col)
    return df.filter(ts >= start if inclusive else ts > start)


def until(df: DataFrame, ts_col: str, end: Column) -> DataFrame:
    """Rows up to and with ``end``."""
    if "dt" in df.columns:
        df = df.filter(F.col("dt") <= utc_day(end))
    return df.filter(F.col(ts_col) <= end)


def recent(
    df: DataFrame, as_of: When, minutes: float = 5, ts_col: str = "received_at"
) -> DataFrame:
    """Rows of the last minutes before ``as_of``, its lower end excluded."""
    now = instant(as_of)
    return until(since(df, ts_col, minus(now, minutes=minutes), False), ts_col, now)


def settled(
    df: DataFrame, as_of: When, minutes: float = 1, ts_col: str = "received_at"
) -> DataFrame:
    """Rows old enough that no more of their kind are on their way."""
    edge = minus(instant(as_of), minutes=minutes)
    if "dt" in df.columns:
        df = df.filter(F.col("dt") <= utc_day(edge))
    return df.filter(F.col(ts_col) < edge)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    Spark applies the rank limit before the shuffle as well, so a key with very many rows
    sends one row per input partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _newest_first(df: DataFrame) -> list[Column]:
    ties = ["received_at", "feed_timestamp", "agency_id", "raw_payload_hash"]
    return [F.col(c).desc_nulls_last() for c in ties if c in df.columns]


def current_positions(
    df: DataFrame, as_of: When, minutes: float = 5, by: Sequence[str] = ("vehicle_id",)
) -> DataFrame:
    """Newest position per key within the last minutes."""
    live = recent(df, as_of, minutes).filter(F.col("vehicle_id").isNotNull())
    return latest_per_key(live, by, _newest_first(live))


def latest_positions(
    df: DataFrame,
    as_of: When,
    route_id: str | None = None,
    limit: int | None = None,
    minutes: float = 5,
) -> DataFrame:
    """Newest position of each vehicle, in order of vehicle id; with a ``limit`` (1..5000,
    as the query interface has it) the first so many.

    A route filter applies before the newest row is chosen.
    """
    if limit is not None and not 1 <= limit <= 5000:
        raise ValueError("limit must be 1..5000")
    if route_id:
        df = df.filter(F.col("route_id") == route_id)
    rows = current_positions(df, as_of, minutes).select(*POSITION_COLUMNS).orderBy("vehicle_id")
    return rows if limit is None else rows.limit(limit)


def vehicle_history(
    df: DataFrame,
    vehicle_id: str,
    start: When | None = None,
    end: When | None = None,
) -> DataFrame:
    """Positions of one vehicle, newest first."""
    rows = df.filter(F.col("vehicle_id") == vehicle_id)
    if start is not None:
        rows = since(rows, "received_at", instant(start), True)
    if end is not None:
        hi = instant(end)
        rows = until(rows, "received_at", hi).filter(F.col("received_at") < hi)
    return rows.orderBy(*_newest_first(rows))


def vehicles_in_box(
    df: DataFrame, south: float, west: float, north: float, east: float
) -> DataFrame:
    """Rows inside a box; ``west > east`` means a box across the date line."""
    lat, lon = F.col("latitude"), F.col("longitude")
    if west <= east:
        across = (lon >= west) & (lon <= east)
    else:
        across = (lon >= west) | (lon <= east)
    return df.filter((lat >= south) & (lat <= north) & across)


def daily_counts(
    feeds: Mapping[str, DataFrame], as_of: When, days: int = 14, ts_col: str = "received_at"
) -> DataFrame:
    """Rows per UTC day and feed from ``days`` before ``as_of`` up to it; newest day first."""
    now = instant(as_of)
    start = minus(now, days=days)
    parts = [
        until(since(df, ts_col, start, True), ts_col, now)
        .groupBy(utc_day(ts_col).alias("day"))
        .agg(F.count("*").alias("record_count"))
        .select(
            day_text(F.col("day")).alias("day"),
            F.lit(key).alias("feed_key"),
            "record_count",
        )
        for key, df in feeds.items()
    ]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts.orderBy(F.col("day").desc(), "feed_key")
