"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopclock.session import scratch_path

#: Text bytes that one step of a Python operator holds at a time.
CHUNK_BYTES = 1 << 20


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece has about ``limit`` text bytes, one row at least."""
    sizes = pc.binary_length(batch.column(column)).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        size = size or 0
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there, a lost
    executor costs no recomputation, and Spark knows the size of what it reads."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Slots of ``split_by``: at most so many numbers are broadcast, whatever the data.
SLOTS = 1 << 20


def split_by(df: DataFrame, number: Column, keys: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose ``number`` may be among the ``key`` values of ``keys``, and those
    for which it cannot be.

    Numbers are compared by their slot.  The used slots are broadcast, so the second part
    needs no shuffle; the first one still needs an exact join.  With very many keys all slots
    are used and all rows are in the first part.
    """
    slots = keys.select(F.pmod(key, F.lit(SLOTS)).alias("__slot")).distinct()
    same = F.pmod(number, F.lit(SLOTS)) == F.col("__slot")
    return df.join(F.broadcast(slots), same, "left_semi"), df.join(F.broadcast(slots), same, "left_anti")


def shuffle_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_id_order(docs: DataFrame, parts: int | None = None) -> tuple[DataFrame, list[tuple[int, int | None]]]:
    """Deal (doc_id, text) rows into ``parts`` ranges of ascending doc_id (null first).

    Returns the rows with their ``part`` number, not yet shuffled, and for each part that has
    rows the smallest doc_id in it, in order: as many pairs as parts at most.
    """
    spark = docs.sparkSession
    parts = parts or shuffle_count(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = rows.stat.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 else []
    bounds = sorted({int(c) for c in cuts})
    part = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("doc_id"))) if bounds else F.lit(0)
    part = F.when(F.col("doc_id").isNull(), 0).otherwise(part).cast("int")
    rows = rows.withColumn("part", part)
    heads = rows.groupBy("part").agg(F.min_by("doc_id", F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("head"))
    return rows, [(r["part"], r["head"]) for r in heads.orderBy("part").collect()]
