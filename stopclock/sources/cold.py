"""Scans of day-partitioned event tables and of the archive."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopclock.functions.times import day, instant, utc_day
from stopclock.schemas import EVENT_TABLES


def scan_events(
    df: DataFrame, ts_col: str, start: Column | datetime | str, end: Column | datetime | str
) -> DataFrame:
    """Rows with ``start <= ts < end``.

    Where the table has a ``dt`` day column the same bound is put on it, so that only the
    days in question are listed and read.
    """
    lo, hi = instant(start), instant(end)
    if "dt" in df.columns:
        df = df.filter((F.col("dt") >= utc_day(lo)) & (F.col("dt") <= utc_day(hi)))
    return df.filter((F.col(ts_col) >= lo) & (F.col(ts_col) < hi))


def scan_cold(
    spark: SparkSession,
    root: str,
    feed: str,
    day_from: Column | date | str | None = None,
    day_to: Column | date | str | None = None,
) -> DataFrame:
    """Archived days ``day_from`` to ``day_to``, both included, with declared types."""
    table = EVENT_TABLES[feed]
    df = spark.read.schema(f"{table.ddl}, dt date").parquet(f"{root.rstrip('/')}/{feed}")
    if day_from is not None:
        df = df.filter(F.col("dt") >= day(day_from))
    if day_to is not None:
        df = df.filter(F.col("dt") <= day(day_to))
    return df
