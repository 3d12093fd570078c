"""Daily archive: export of one UTC day, check of what was written, and retention."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stopclock import storage
from stopclock.functions.times import utc_day
from stopclock.operators.retention import expired_partitions, partition_name
from stopclock.schemas import EVENT_TABLES, HOT_DAYS
from stopclock.sources.cold import scan_cold, scan_events


def export_day(
    events: DataFrame,
    root: str | None,
    feed: str,
    target: date,
    ts_col: str = "received_at",
    max_rows_per_file: int = 5_000_000,
) -> dict[str, object]:
    """Write one UTC day of a feed to ``root/feed/dt=.../`` in time order, and return what
    was written.  A repeated run replaces that day and no other.

    The rows of one poll share their time, so the range split also goes by a hash of the
    row key: however many rows one poll has, they can go to several tasks.
    """
    summary: dict[str, object] = {"feed": feed, "day": target.isoformat()}
    if not root:
        return {**summary, "status": "skipped_no_target", "rows": 0, "bytes": 0}
    table = EVENT_TABLES[feed]
    start = datetime.combine(target, datetime.min.time(), tzinfo=timezone.utc)
    rows = scan_events(events, ts_col, start, start + timedelta(days=1)).select(*table.columns)
    if rows.isEmpty():
        return {**summary, "status": "skipped_no_data", "rows": 0, "bytes": 0}
    spread = F.xxhash64(*[c for c in table.key if c != ts_col])
    counted = Observation()
    path = f"{root.rstrip('/')}/{feed}"
    (
        rows.repartitionByRange(F.col(ts_col), spread)
        .sortWithinPartitions(ts_col)
        .withColumn("dt", F.lit(target))
        .observe(counted, F.count("*").alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy("dt")
        .parquet(path)
    )
    size = storage.folder_bytes(events.sparkSession, f"{path}/dt={target.isoformat()}")
    return {**summary, "status": "ok", "rows": counted.get["rows"], "bytes": size}


def verify_export(
    spark: SparkSession, root: str, feed: str, target: date, expected_rows: int
) -> DataFrame:
    """Checks of an exported day, one row each: check, expected, found, passed."""
    table = EVENT_TABLES[feed]
    stored = scan_cold(spark, root, feed, target, target)
    outside = (utc_day("received_at") != F.col("dt")) | F.col("received_at").isNull()
    # The files' own schema, which the declared one must agree with.
    names = spark.read.parquet(f"{root.rstrip('/')}/{feed}/dt={target.isoformat()}").columns
    measured = stored.agg(
        F.count("*").alias("rows"), F.count_if(outside).alias("outside")
    )

    def line(check: str, expected, found) -> F.Column:
        return F.struct(
            F.lit(check).alias("check"),
            F.lit(expected).cast("long").alias("expected"),
            found.cast("long").alias("found"),
        )

    return measured.select(
        F.inline(
            F.array(
                line("rows", expected_rows, F.col("rows")),
                line("columns", len(table.columns), F.lit(len(names))),
                line("rows_of_other_days", 0, F.col("outside")),
            )
        )
    ).withColumn("passed", F.col("expected") == F.col("found"))


def drop_days(
    spark: SparkSession, root: str, feed: str, today: date, keep_days: int = HOT_DAYS
) -> list[str]:
    """Delete the day folders of an event table that are older than ``keep_days``; returns
    the partition names.  Only folders are touched, no data is read."""
    path = f"{root.rstrip('/')}/{feed}"
    days = storage.day_folders(spark, path)
    if not days:
        return []
    names = (
        spark.createDataFrame([(d,) for d in days], "dt date")
        .select("dt", partition_name(feed, F.col("dt")).alias("name"))
    )
    expired = expired_partitions(names, feed, today, keep_days).orderBy("dt").collect()
    for row in expired:
        storage.delete_folder(spark, f"{path}/dt={row['dt'].isoformat()}")
    return [row["name"] for row in expired]
