"""Keyed tables dealt over buckets: a merge rewrites the buckets that its batch touches.

A bucket is a partition folder, chosen by a hash of the key; how many there are is fixed
when the table is first written.  A merge reads the touched buckets only, writes what they
become to a folder of its own, and then lets Spark overwrite just those partitions from it.
A note beside the table says which merge is under way, so one that was cut off is finished
before the next begins; doing that again changes nothing.  A table has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopclock import storage
from stopclock.plans.tables import table_path
from stopclock.schemas import Table

BUCKETS = 16
_COUNT, _PENDING, _APPLIED, _STAGED = "_buckets", "_pending", "_applied", "_staged-"


def bucket_of(table: Table, count: int) -> Column:
    return F.pmod(F.xxhash64(*table.key), F.lit(count)).cast("int")


def _with_bucket(spark: SparkSession, table: Table, path: str) -> DataFrame:
    return spark.read.schema(f"{table.ddl}, bucket int").parquet(path)


def read_buckets(
    spark: SparkSession, root: str, table: Table, buckets: list[int] | None = None
) -> DataFrame:
    """The table, or some buckets of it; empty where nothing was written yet."""
    path = table_path(root, table)
    if not any(n.startswith("bucket=") for n in storage.folders(spark, path)):
        return spark.createDataFrame([], table.ddl)
    rows = _with_bucket(spark, table, path)
    if buckets is not None:
        rows = rows.filter(F.col("bucket").isin(buckets))
    return rows.select(*table.columns)


def merge_buckets(
    spark: SparkSession,
    root: str,
    table: Table,
    batch: DataFrame,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    token: str | None = None,
    buckets: int = BUCKETS,
) -> list[int]:
    """Merge a batch and return the buckets it touched.

    ``merge`` gets the current rows of those buckets and the batch, and may return fewer
    rows than it was given.  ``token`` names the batch: the one merged last is not merged
    again.
    """
    path = table_path(root, table)
    _finish(spark, table, path)
    if token and storage.get_text(spark, path, _APPLIED) == token:
        return []
    known = storage.get_text(spark, path, _COUNT)
    if known is None:
        storage.put_text(spark, path, _COUNT, str(buckets))
    count = int(known or buckets)
    rows = batch.withColumn("bucket", bucket_of(table, count)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())
        if touched:
            merged = merge(read_buckets(spark, root, table, touched), rows.drop("bucket"))
            staged = f"{_STAGED}{uuid.uuid4().hex}"
            _overwrite(merged.select(*table.columns, bucket_of(table, count).alias("bucket")), f"{path}/{staged}")
            note = f"{staged} {token or '-'} {','.join(map(str, touched))}"
            storage.put_text(spark, path, _PENDING, note)
            _finish(spark, table, path)
        return touched
    finally:
        rows.unpersist()


def _overwrite(rows: DataFrame, path: str) -> None:
    (
        rows.hint("rebalance", "bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("bucket")
        .parquet(path)
    )


def _finish(spark: SparkSession, table: Table, path: str) -> None:
    """Bring the merge that is under way, if any, to its end."""
    note = storage.get_text(spark, path, _PENDING)
    if note is not None:
        staged, token, touched = note.split(" ")
        filled = storage.folders(spark, f"{path}/{staged}")
        if any(n.startswith("bucket=") for n in filled):
            _overwrite(_with_bucket(spark, table, f"{path}/{staged}"), path)
        for bucket in touched.split(","):
            if f"bucket={bucket}" not in filled:
                storage.delete_folder(spark, f"{path}/bucket={bucket}")
        if token != "-":
            storage.put_text(spark, path, _APPLIED, token)
        storage.delete_folder(spark, f"{path}/{_PENDING}")
    for name in storage.folders(spark, path):
        if name.startswith(_STAGED):
            storage.delete_folder(spark, f"{path}/{name}")
