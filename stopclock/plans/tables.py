"""Writing event tables and keyed tables.

Event tables are Parquet folders partitioned by UTC day; a batch touches only its own
days.  Keyed tables are whole versions: a merge writes the next version beside the current
one and moves the pointer, since a plan cannot overwrite what it reads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stopclock import storage
from stopclock.functions.times import utc_day
from stopclock.operators.feed_rows import split_on_key
from stopclock.operators.merges import append_new
from stopclock.schemas import Table


def table_path(root: str, table: Table) -> str:
    return f"{root.rstrip('/')}/{table.name}"


def read_events(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """An event table with its day column; empty where nothing was written yet."""
    path = table_path(root, table)
    ddl = f"{table.ddl}, dt date"
    if not storage.exists(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(path)


def append_events(
    spark: SparkSession,
    root: str,
    table: Table,
    batch: DataFrame,
    ts_col: str = "received_at",
) -> DataFrame:
    """Append the rows of a batch whose key is new, and return those with an incomplete
    key, which were left out.

    Only the days that the batch has are read for the comparison.  Running it again adds
    nothing.
    """
    rows, unkeyed = split_on_key(batch.select(*table.columns), table.key)
    append_counted(spark, root, table, rows, ts_col)
    return unkeyed


def append_all(rows: DataFrame, root: str, table: Table, ts_col: str = "received_at") -> None:
    """Append rows whose keys are known to be new."""
    (
        rows.select(*table.columns, utc_day(ts_col).alias("dt"))
        .write.mode("append")
        .partitionBy("dt")
        .option("compression", "zstd")
        .parquet(table_path(root, table))
    )


def append_counted(
    spark: SparkSession, root: str, table: Table, rows: DataFrame, ts_col: str = "received_at"
) -> int:
    """Append the rows whose key is new and return how many they were.  All keys are whole.

    The batch is kept while its days are listed and written, so it is made once.
    """
    rows = rows.select(*table.columns).withColumn("dt", utc_day(ts_col))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        days = [r["dt"] for r in rows.select("dt").distinct().collect()]  # days, not rows
        if not days:
            return 0
        current = read_events(spark, root, table).filter(F.col("dt").isin(days))
        counted = Observation()
        (
            append_new(current, rows, table.key)
            .hint("rebalance", "dt")
            .observe(counted, F.count("*").alias("rows"))
            .write.mode("append")
            .partitionBy("dt")
            .option("compression", "zstd")
            .parquet(table_path(root, table))
        )
        return counted.get["rows"]
    finally:
        rows.unpersist()


def _keyed_path(root: str, table: Table, part: str | None) -> str:
    path = table_path(root, table)
    return f"{path}/{part}" if part else path


def read_keyed(
    spark: SparkSession, root: str, table: Table, part: str | None = None
) -> DataFrame:
    """Current version of a keyed table, or of one part of it; empty where there is none."""
    version = storage.current_version(spark, _keyed_path(root, table, part))
    if version is None:
        return spark.createDataFrame([], table.ddl)
    return spark.read.schema(table.ddl).parquet(version)


def merge_keyed(
    spark: SparkSession,
    root: str,
    table: Table,
    batch: DataFrame,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    part: str | None = None,
    token: str | None = None,
    keep_versions: int = 3,
) -> bool:
    """Merge a batch into a keyed table as its next version; older versions beyond the
    last few are dropped.

    A table, or a part of it, has one writer at a time.  ``token`` names the batch: if the
    current version was made from it, nothing is done and False returned, so a batch that
    comes again after a failure counts once.
    """
    path = _keyed_path(root, table, part)
    before = storage.current_version(spark, path)
    if token and before and before.endswith(f"-{token}"):
        return False
    version = storage.new_version(path) + (f"-{token}" if token else "")
    merged = merge(read_keyed(spark, root, table, part), batch)
    merged.select(*table.columns).write.option("compression", "zstd").parquet(version)
    storage.point_to(spark, path, version)
    _drop_old_versions(spark, path, {version, before}, keep_versions)
    return True


def _drop_old_versions(
    spark: SparkSession, path: str, in_use: set[str | None], keep: int
) -> None:
    names = storage.folders_by_age(spark, path)
    spare = [n for n in names if n.startswith("v-") and f"{path}/{n}" not in in_use]
    for name in spare[: max(0, len(spare) + len(in_use) - keep)]:
        storage.delete_folder(spark, f"{path}/{name}")
