"""The stored delay history: what the live delay state lands, batch by batch.

Frozen rows (final or abandoned) are appended below their service day in a folder named
after the micro-batch, so a batch that comes again replaces its own rows and no earlier row
is ever rewritten.  Open predictions live in a small bucketed table that a row leaves when it
is frozen.  Of rows of one visit the one of the latest micro-batch counts.
"""

from __future__ import annotations

import uuid
from datetime import date
from hashlib import md5

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stopclock import storage
from stopclock.functions.times import day
from stopclock.operators.events import latest_per_key
from stopclock.plans.buckets import merge_buckets, read_buckets
from stopclock.plans.tables import table_path
from stopclock.schemas import STOP_DELAY, STOP_DELAY_OPEN

OPEN = "predicted"
#: How folders are named that ``compact_delays`` gathers a day in.
WHOLE_DAY = "day"


def _still_open(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Open rows after a batch: its rows replace those of their visits, and leave if frozen."""
    left = current.join(batch.select(*STOP_DELAY.key), list(STOP_DELAY.key), "left_anti")
    return left.select(*current.columns).unionByName(batch.filter(F.col("status") == OPEN).select(*current.columns))


def land_delays(spark: SparkSession, root: str, changes: DataFrame, batch_id: int, token: str) -> None:
    """Land the changed delays of one micro-batch; landing it again changes nothing.

    ``token`` names the batch.  Batch numbers rise; a root belongs to one stream.
    """
    newest = [(F.col("status") == OPEN).asc(), F.col("updated_at").desc()]
    last = latest_per_key(changes, STOP_DELAY.key, newest).withColumn("batch_id", F.lit(batch_id).cast("long"))
    last = last.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _write(last.filter(F.col("status") != OPEN).withColumn("batch", F.lit(token)), root)
        merge_buckets(spark, root, STOP_DELAY_OPEN, last, _still_open, token)
    finally:
        last.unpersist()


def _write(frozen: DataFrame, root: str) -> None:
    (
        frozen.hint("rebalance", "start_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("start_date", "batch")
        .parquet(table_path(root, STOP_DELAY))
    )


def _frozen(spark: SparkSession, root: str) -> DataFrame:
    path = table_path(root, STOP_DELAY)
    ddl = f"{STOP_DELAY_OPEN.ddl}, batch string"
    if not any(n.startswith("start_date=") for n in storage.folders(spark, path)):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(path)


def read_delays(
    spark: SparkSession,
    root: str,
    day_from: Column | date | str | None = None,
    day_to: Column | date | str | None = None,
) -> DataFrame:
    """Stop delays of the service days ``day_from`` to ``day_to``, one row per visit."""
    columns = STOP_DELAY_OPEN.columns
    rows = _frozen(spark, root).select(*columns).unionByName(read_buckets(spark, root, STOP_DELAY_OPEN))
    if day_from is not None:
        rows = rows.filter(F.col("start_date") >= day(day_from))
    if day_to is not None:
        rows = rows.filter(F.col("start_date") <= day(day_to))
    return latest_per_key(rows, STOP_DELAY.key, [F.col("batch_id").desc()]).select(*STOP_DELAY.columns)


def compact_delays(spark: SparkSession, root: str, service_day: date) -> int:
    """Gather the batches of one service day in one folder; returns how many there were.

    The gathered rows get a folder of a new name; until the old ones are gone readers see rows
    twice and count them once.
    """
    folder = f"{table_path(root, STOP_DELAY)}/start_date={service_day.isoformat()}"
    batches = [n for n in storage.folders(spark, folder) if n.startswith("batch=")]
    if len(batches) > 1:
        rows = _frozen(spark, root).filter(F.col("start_date") == F.lit(service_day))
        rows = latest_per_key(rows, STOP_DELAY.key, [F.col("batch_id").desc()])
        _write(rows.withColumn("batch", F.lit(f"{WHOLE_DAY}-{uuid.uuid4().hex}")), root)
        for name in batches:
            storage.delete_folder(spark, f"{folder}/{name}")
    return len(batches)


def land_delay_stream(
    live: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Start landing a stream of changed delays (``live_delays``).  The default trigger takes
    what is there and stops."""
    stream_id = md5(checkpoint.encode()).hexdigest()[:8]

    def land(changes: DataFrame, batch_id: int) -> None:
        land_delays(changes.sparkSession, root, changes, batch_id, f"{stream_id}.{batch_id}")

    return (
        live.writeStream.foreachBatch(land)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
