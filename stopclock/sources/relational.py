"""Relational tables over JDBC: a scan split on a time column, and appends."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession


def bounds_query(table: str, ts_col: str, before: datetime) -> str:
    """SQL for the range of the split column; the database does the aggregation."""
    stamp = _literal(before)
    return (
        f"SELECT min({ts_col}) AS lo, max({ts_col}) AS hi FROM {table} "
        f"WHERE {ts_col} < TIMESTAMP WITH TIME ZONE '{stamp}'"
    )


def frozen_query(table: str, ts_col: str, before: datetime) -> str:
    """SQL for the rows older than ``before``, as a subquery that Spark can split.

    The bounds of a split read only set its stride, so the limit has to be a real filter.
    """
    stamp = _literal(before)
    return f"(SELECT * FROM {table} WHERE {ts_col} < TIMESTAMP WITH TIME ZONE '{stamp}') AS frozen"


def _literal(ts: datetime) -> str:
    if ts.tzinfo is not None:
        ts = ts.astimezone(timezone.utc).replace(tzinfo=None)
    # The offset keeps the bound where it is, whatever the zone of the database session.
    return ts.isoformat(sep=" ", timespec="microseconds") + "+00:00"


def jdbc_range_scan(
    spark: SparkSession,
    url: str,
    table: str,
    ts_col: str,
    n_parts: int = 4,
    freeze_lag: timedelta = timedelta(minutes=1),
    as_of: datetime | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of ``table`` older than ``as_of - freeze_lag``, read in ``n_parts`` splits of
    the time column between its smallest and largest value.

    Runs one small query at once, for those two values.
    """
    before = (as_of or datetime.now(timezone.utc)) - freeze_lag
    reader = spark.read.format("jdbc").option("url", url).options(**(options or {}))
    lo, hi = reader.option("query", bounds_query(table, ts_col, before)).load().first()
    rows = (
        spark.read.format("jdbc")
        .option("url", url)
        .options(**(options or {}))
        .option("dbtable", frozen_query(table, ts_col, before))
    )
    if lo is None:
        return rows.load()
    return (
        rows.option("partitionColumn", ts_col)
        .option("lowerBound", str(lo))
        .option("upperBound", str(hi))
        .option("numPartitions", str(n_parts))
        .load()
    )


def jdbc_append(
    df: DataFrame,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    connections: int = 8,
) -> None:
    """Append an aggregate to a relational table over at most ``connections`` sessions."""
    (
        df.coalesce(connections)
        .write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("dbtable", table)
        .options(**(options or {}))
        .save()
    )
