"""Connected components of an edge table, by alternating star steps.

In a large-star step every node points its larger neighbours to its smallest one; in a
small-star step its smaller ones.  Paths shrink to stars in few rounds, and a node of very
many edges is only ever grouped by a minimum, which Spark adds up before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopclock.llm.common import cut


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return (
        both.join(least, F.col("u") == F.col("w"))
        .filter("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    """``u`` is the larger end of every edge."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    moved = (
        edges.join(least, F.col("u") == F.col("w"))
        .filter("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.union(least.select("w", "m")).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    # Exact sums of two halves of the hash: the same edges give the same pair.
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return int(row[0]), int(row[1] or 0)


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``edges`` (u, v).

    Edges with a null end are ignored, loops only name their node, repeated edges count
    once, and no edges give no nodes.  Each round is written to the shared folder.
    """
    edges = edges.filter("u IS NOT NULL AND v IS NOT NULL").distinct()
    edges = cut(edges, "edges")
    alone = edges.filter("u = v").select("u").distinct()
    now = cut(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    state = _state(now)
    while state[0]:
        now = cut(_small(_large(now)), "edges")
        after = _state(now)
        if after == state:
            break
        state = after
    nodes = now.select("u", "v").union(now.select("v", "v").distinct())
    return (
        nodes.union(alone.select("u", F.col("u").alias("v")))
        .groupBy(F.col("u").alias("node"))
        .agg(F.min("v").alias("component"))
    )
