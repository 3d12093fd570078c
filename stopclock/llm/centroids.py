"""Clusters of whole-number vectors around centroids, with bit-plane arithmetic.

Components become whole numbers.  The 64 bits of one weight, one from each component, are
packed into one word (a bit plane); in two's complement the topmost plane has a negative
weight.  The dot product of a vector and a centroid is the sum, over their pairs of planes,
of the product of two weights with the number of common bits, so it is exact, and so is the
squared distance |v|^2 - 2 v.c + |c|^2.

Planes are made once and written to the shared folder.  A round is one pass over them: each
task assigns its vectors and adds up its own clusters, so no more than the sums of a few
centroids leave it, and the driver holds centroids only.

Results in special cases: a vector that is null, has not exactly 64 components or holds a
null or non-finite one is left out; a component of 131,072 or more in size raises an error,
since squared distances would not fit 64 bits; a vector without an id is clustered but is no
first centroid; rows that share an id are separate vectors, the smaller one first where their
hash ties as a first centroid; with fewer vectors than centroids there are as many centroids
as vectors with an id; without any the result is empty.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopclock.llm.common import cut
from stopclock.llm.vectors import clean_matrices, scaled

DIMENSIONS = 64
CENTROIDS, ROUNDS, SEED = 8, 10, 3
#: Vectors that one step compares, so that planes and counts stay in a processor's cache.
STEP = 4096

PREPARED = "vec_id bigint, x array<int>, planes array<bigint>, square bigint"


def bit_planes(x: np.ndarray) -> np.ndarray:
    """The planes of rows of 64 whole numbers, as (planes, rows) words, lowest weight first,
    the sign plane last."""
    size = int(np.abs(x).max(initial=0)).bit_length() + 1
    planes = np.empty((size, len(x)), dtype=np.uint64)
    for b in range(size):
        bits = ((x >> b) & 1).astype(np.uint8)
        planes[b] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    return planes


def weights(size: int) -> list[int]:
    """What the planes of a two's complement number of ``size`` bits count."""
    return [1 << b for b in range(size - 1)] + [-(1 << (size - 1))]


def dots(planes: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact dot products of all vectors with the planes of one centroid (a column)."""
    total = np.zeros(planes.shape[1], dtype=np.int64)
    for a, word in zip(weights(len(centroid)), centroid, strict=True):
        for b, plane in zip(weights(len(planes)), planes, strict=True):
            total += np.bitwise_count(plane & word).astype(np.int64) * (a * b)
    return total


def squares(planes: np.ndarray) -> np.ndarray:
    """Exact squared length of each vector, from the common bits of its own planes."""
    total = np.zeros(planes.shape[1], dtype=np.int64)
    each = weights(len(planes))
    for i, a in enumerate(each):
        for j in range(i, len(each)):
            both = np.bitwise_count(planes[i] & planes[j]).astype(np.int64)
            total += both * (a * each[j] * (1 if i == j else 2))
    return total


def nearest(planes: np.ndarray, square: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smaller one of equals) and the squared distance."""
    marks = bit_planes(centroids)
    own = squares(marks)
    best = np.zeros(planes.shape[1], dtype=np.int32)
    least = np.empty(planes.shape[1], dtype=np.int64)
    for start in range(0, planes.shape[1], STEP):
        part = slice(start, start + STEP)
        far = np.stack([own[k] - 2 * dots(planes[:, part], marks[:, k]) for k in range(len(centroids))])
        best[part] = far.argmin(axis=0)
        least[part] = far.min(axis=0) + square[part]
    return best, least


def prepare(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, x (whole numbers), planes, square of every vector that takes part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in clean_matrices(batch.column("vector")):
                if matrix.shape[1] != DIMENSIONS:
                    continue
                x = scaled(matrix)
                planes = bit_planes(x)
                count, size = len(x), len(planes)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(rows)),
                        _lists(x.astype(np.int32), count, DIMENSIONS),
                        _lists(np.ascontiguousarray(planes.T).view(np.int64), count, size),
                        pa.array(squares(planes)),
                    ],
                    names=["vec_id", "x", "planes", "square"],
                )

    named = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    return named.mapInArrow(run, PREPARED)


def _lists(values: np.ndarray, count: int, size: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(count + 1, dtype=np.int32) * size), pa.array(values.ravel()))


def _planes_of(column: pa.ListArray) -> np.ndarray:
    """Rows of planes as (planes, rows); rows with fewer planes repeat their sign."""
    ends = np.asarray(column.offsets).astype(np.int64)
    size = np.diff(ends)
    at = np.minimum(np.arange(int(size.max(initial=1)))[:, None], (size - 1)[None, :])
    return column.values.to_numpy()[ends[:-1] + at].view(np.uint64)


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return nearest(_planes_of(batch.column("planes")), batch.column("square").to_numpy(), centroids)


def _sums(prepared: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Size and componentwise sum of every cluster that has vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), dtype=np.int64)
        total = np.zeros((len(centroids), DIMENSIONS), dtype=np.int64)
        for batch in batches:
            best, _ = _assigned(batch, centroids)
            x = batch.column("x").flatten().to_numpy().reshape(-1, DIMENSIONS)
            for k in range(len(centroids)):
                mine = best == k
                count[k] += np.count_nonzero(mine)
                total[k] += x[mine].sum(axis=0, dtype=np.int64)
        number = np.arange(len(centroids), dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(number), pa.array(count), _lists(total, len(centroids), DIMENSIONS)], names=["cluster", "n", "s"]
        )

    parts = prepared.mapInArrow(run, "cluster int, n bigint, s array<bigint>").filter("n > 0")
    each = parts.select("cluster", "n", F.posexplode("s").alias("at", "s"))
    added = each.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    found: dict[int, tuple[int, list[int]]] = {}
    for r in added:  # one row per centroid and component
        found.setdefault(r["cluster"], (r["n"], [0] * DIMENSIONS))[1][r["at"]] = r["s"]
    return found


def first_centroids(prepared: DataFrame, number: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The vectors whose id has the smallest hashes."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    marked = prepared.filter("vec_id IS NOT NULL").select(mark.alias("mark"), "x")
    chosen = marked.orderBy("mark", "x").limit(number).collect()
    return np.array([r["x"] for r in chosen], dtype=np.int64).reshape(-1, DIMENSIONS)


def moved(prepared: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round; the one of an empty cluster stays."""
    after = centroids.copy()
    for k, (count, total) in _sums(prepared, centroids).items():
        after[k] = [s // count for s in total]
    return after


def assign(prepared: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance (squared)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, least = _assigned(batch, centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(best), pa.array(least)], names=["vec_id", "cluster", "distance"]
            )

    return prepared.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def fit(
    prepared: DataFrame, number: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED
) -> np.ndarray:
    """Centroids after all rounds, as rows of whole numbers."""
    centroids = first_centroids(prepared, number, seed)
    for _ in range(rounds if len(centroids) else 0):
        after = moved(prepared, centroids)
        if (after == centroids).all():
            break  # every further round would give the same
        centroids = after
    return centroids


def cluster(
    vectors: DataFrame,
    vector: str = "embedding",
    number: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid (array) of every vector."""
    prepared = cut(prepare(vectors, vector), "bit-planes")
    centroids = fit(prepared, number, rounds, seed)
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema)
    rows = cut(assign(prepared, centroids), "clusters")
    spread = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    by_number = F.array(*(F.lit(spread.get(k, 0)).cast("bigint") for k in range(len(centroids))))
    places = F.array(*(F.array(*(F.lit(c).cast("bigint") for c in row)) for row in centroids.tolist()))
    return rows.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(by_number, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(spread.values())).cast("bigint").alias("inertia"),
        F.get(places, F.col("cluster")).alias("centroid"),
    )
