"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation flips signs at random and applies a fast Hadamard transform, three times
over.  The hash of a vector in one table is the signed axis nearest to the rotated unit
vector.  A query looks into the buckets of its nearest axes in every table; the rows there are
its candidates, and their distances are taken exactly on the original vectors.

Rows are dealt to blocks of bounded size by a hash, so that neither a crowded bucket nor
copies of one vector fill a task; every query visits every block once.  A block holds its rows
with the order of every table, the queries stream past it, and of each query only its nearest
few leave the block.  Rotations are the same everywhere, so the result does not depend on the
blocks.  Inside a block equal vectors are one candidate with their smallest ids, which is
exact.

A query looks into ``LOOKUPS`` buckets over all tables, however many rows there are, so what
it finds among its candidates does not change with the number of other rows.  They are dealt
evenly over ``TABLES`` tables, the nearest axis of each first; tables without any are not
built.  Each bucket has about 1/128 of the rows in 64 dimensions.  Neighbours get nearer with
more rows, so the recall only rises with them: ``LOOKUPS`` is what 500 rows without any
structure in 64 dimensions, the hardest case, need for well over 0.9 of the 10 nearest.

Results in special cases: vectors that are null, zero or empty, or hold a null or non-finite
component, and rows without an id take no part; only vectors of one length meet; equal rows
count once; rows that share an id but not the vector stand for themselves, both as queries and
as candidates, and a query meets no row of its own id; equal distances go by the smaller id;
vectors are hashed by their direction, so the figures above are for vectors of like norm;
empty tables give an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopclock.llm.common import shuffle_count
from stopclock.llm.vectors import clean_matrices

NEAREST, TABLES, LOOKUPS, SEED, TURNS = 10, 32, 160, 7, 3
#: The number of rows that ``LOOKUPS`` is made for, the least favourable.
LOOKUP_ROWS = 500
#: Components that one block of rows holds at most, give or take the hash.
BLOCK_VALUES = 1 << 24
#: Queries that pass a block together, and vectors rotated together.
QUERY_STEP, ROTATE_STEP = 512, 4096
#: Candidates of one query in one bucket beyond which equal distances are settled at once.
TIED = 1024

FOUND = "query_id bigint, query_key bigint, vec_id bigint, score double"


def signs(d: int, tables: int = TABLES, seed: int = SEED) -> np.ndarray:
    """Random signs (table, turn, padded dimension)."""
    size = 1 << max(1, (d - 1).bit_length())
    drawn = np.random.Generator(np.random.PCG64(seed)).integers(0, 2, (tables, TURNS, size))
    return (2 * drawn - 1).astype(np.float32)


def rotate(columns: np.ndarray, flips: np.ndarray) -> np.ndarray:
    """Pseudo-rotation of vectors that are the columns of a matrix, up to a common factor."""
    y = columns
    for flip in flips:
        y, h = y * flip[:, None], 1
        while h < len(y):
            pair = y.reshape(-1, 2, h, y.shape[1])
            y = np.stack((pair[:, 0] + pair[:, 1], pair[:, 0] - pair[:, 1]), axis=1).reshape(y.shape)
            h *= 2
    return y


def _columns(matrix: np.ndarray) -> np.ndarray:
    """Unit vectors as columns, padded to a power of two."""
    size = 1 << max(1, (matrix.shape[1] - 1).bit_length())
    out = np.zeros((size, len(matrix)), dtype=np.float32)
    # Scaled first, so that no square overflows.
    scale = matrix.astype(np.float64) / np.abs(matrix).max(axis=1, keepdims=True)
    out[: matrix.shape[1]] = (scale / np.linalg.norm(scale, axis=1, keepdims=True)).T
    return out


def hashes(matrix: np.ndarray, tables: int = TABLES, seed: int = SEED) -> np.ndarray:
    """The nearest signed axis of every vector in every table: the axis, or its number plus
    the dimension for the negative side."""
    flips = signs(matrix.shape[1], tables, seed)
    out = np.empty((tables, len(matrix)), dtype=np.int32)
    for start in range(0, len(matrix), ROTATE_STEP):
        columns = _columns(matrix[start : start + ROTATE_STEP])
        for t in range(tables):
            y = rotate(columns, flips[t])
            axis = np.abs(y).argmax(axis=0)
            out[t, start : start + ROTATE_STEP] = axis + len(y) * (y[axis, np.arange(y.shape[1])] < 0)
    return out


def probes_of(matrix: np.ndarray, count: int, tables: int = TABLES, seed: int = SEED) -> np.ndarray:
    """The ``count`` nearest signed axes of every vector in every table, nearest first."""
    flips = signs(matrix.shape[1], tables, seed)
    columns = _columns(matrix)
    both = [np.concatenate((y, -y)) for y in (rotate(columns, flips[t]) for t in range(tables))]
    return np.stack([np.argsort(-y, axis=0, kind="stable")[:count].T for y in both])


def probe_counts(rows: int, tables: int = TABLES, lookups: int = LOOKUPS) -> list[int]:
    """Buckets to look into in each table that is built, for a recall that stays the same with so
    many rows.  ``search`` always takes those for ``LOOKUP_ROWS``."""
    wanted = max(1, round(lookups * (LOOKUP_ROWS / max(1, rows)) ** 0.2))
    return [wanted // tables + (t < wanted % tables) for t in range(min(tables, wanted))]


def _distinct(ids: np.ndarray, matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different vectors, and for each of them its ``most`` smallest ids: (vectors, ids, first
    id of each vector and the end)."""
    flat = np.ascontiguousarray(matrix + 0.0)  # a negative zero becomes zero
    rows = flat.view(np.dtype((np.void, flat.dtype.itemsize * flat.shape[1]))).ravel()
    _, group = np.unique(rows, return_inverse=True)
    order = np.lexsort((ids, group))
    group, ids = group[order], ids[order]
    once = np.append(True, (group[1:] != group[:-1]) | (ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, bool)
    order, group, ids = order[once], group[once], ids[once]
    begin = np.searchsorted(group, np.arange(group[-1] + 1 if len(group) else 0))
    few = np.arange(len(group)) - begin[group] < most
    first = flat[order[begin]]
    group, ids = group[few], ids[few]
    return first, ids, np.searchsorted(group, np.arange(len(first) + 1))


class Block:
    """Rows of one length with the bucket order of every table."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, nearest: int, tables: int, seed: int):
        self.nearest, self.tables, self.seed = nearest, tables, seed
        # One more than asked for: the query's own id may be among them.
        self.vectors, self.ids, self.ends = _distinct(ids, matrix, nearest + 1)
        codes = hashes(self.vectors, tables, seed)
        self.sides = 2 * signs(matrix.shape[1], 1, seed).shape[2]
        self.order = np.argsort(codes, axis=1, kind="stable").astype(np.int32)
        self.begin = np.stack(
            [np.searchsorted(c[o], np.arange(self.sides + 1)) for c, o in zip(codes, self.order, strict=True)]
        )

    def search(self, query_ids: np.ndarray, queries: np.ndarray, probes: list[int]) -> tuple[np.ndarray, ...]:
        """Number of the query, id and distance of the nearest candidates of each query."""
        exact = queries.astype(np.float64)
        own = np.einsum("ij,ij->i", exact, exact)
        bound = np.full(len(exact), np.inf)  # so many are known to be no further
        pairs = []
        near = probes_of(queries, min(max(probes), self.sides), self.tables, self.seed)
        for t, axes in enumerate(near):
            axes = axes[:, : probes[t]]
            who = np.repeat(np.arange(len(exact)), axes.shape[1])
            turn = np.argsort(axes.ravel(), kind="stable")
            axis, who = axes.ravel()[turn], who[turn]
            for a in np.unique(axis).tolist():
                rows = self.order[t, self.begin[t, a] : self.begin[t, a + 1]]
                if len(rows):
                    mine = who[np.searchsorted(axis, a) : np.searchsorted(axis, a, "right")]
                    pairs.append(self._bucket(exact, own, bound, mine, rows))
        pair = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, dtype=np.int64)
        return self._ranked(query_ids, exact, *np.divmod(pair, max(1, len(self.vectors))))

    def _bucket(self, exact, own, bound, mine: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Pairs (query * vectors + row) of one bucket that may be among the nearest."""
        wanted = self.nearest + 1
        points = self.vectors[rows].astype(np.float64)
        norms = np.einsum("ij,ij->i", points, points)
        far = norms[None, :] - 2 * (exact[mine] @ points.T) + own[mine][:, None]
        # Products are rounded; what is this near to the bound is kept and compared exactly.
        slack = 1e-9 * (own[mine] + norms.max())
        near = far <= (bound[mine] + slack)[:, None]
        for i in np.flatnonzero(np.count_nonzero(near, axis=1) > wanted).tolist():
            last = np.partition(far[i], wanted - 1)[wanted - 1]
            bound[mine[i]] = min(bound[mine[i]], last)
            near[i] = far[i] <= last + slack[i]
            tied = np.flatnonzero(near[i])
            if len(tied) > TIED:
                space = np.sqrt(np.square(points[tied] - exact[mine[i]]).sum(axis=1))
                best = np.lexsort((self.ids[self.ends[rows[tied]]], space))[:wanted]
                near[i] = False
                near[i, tied[best]] = True
        q, r = np.nonzero(near)
        return mine[q].astype(np.int64) * len(self.vectors) + rows[r]

    def _ranked(self, query_ids, exact, q: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, ...]:
        space = np.empty(len(q))
        for start in range(0, len(q), 1 << 14):
            part = slice(start, start + (1 << 14))
            gap = exact[q[part]] - self.vectors[r[part]]
            space[part] = np.sqrt(np.square(gap).sum(axis=1))
        copies = self.ends[r + 1] - self.ends[r]
        at = np.repeat(self.ends[r] - np.concatenate(([0], np.cumsum(copies)[:-1])), copies) + np.arange(copies.sum())
        q, space, ids = np.repeat(q, copies), np.repeat(space, copies), self.ids[at]
        other = ids != query_ids[q]
        q, space, ids = q[other], space[other], ids[other]
        turn = np.lexsort((ids, space, q))
        q, space, ids = q[turn], space[turn], ids[turn]
        few = np.arange(len(q)) - np.searchsorted(q, q) < self.nearest
        return q[few], ids[few], space[few]


def _searcher(nearest: int, probes: list[int], seed: int):
    """Rows (asked, id, key, vector) of one block, rows before queries, to FOUND rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        blocks: dict[int, Block] = {}
        for batch in batches:
            asked = batch.column("asked").to_numpy(zero_copy_only=False)
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key"))
            for rows, matrix in clean_matrices(batch.column("vector")):
                some = (matrix != 0).any(axis=1)
                rows, matrix = rows[some], matrix[some]
                d, query = matrix.shape[1], asked[rows]
                if not query.all():
                    held.setdefault(d, []).append((ids[rows[~query]], matrix[~query]))
                rows, matrix = rows[query], matrix[query]
                if len(rows) and d in held:
                    mine, points = (np.concatenate(x) for x in zip(*held.pop(d), strict=True))
                    blocks[d] = Block(mine, points, nearest, len(probes), seed)
                for start in range(0, len(rows) if d in blocks else 0, QUERY_STEP):
                    part = rows[start : start + QUERY_STEP]
                    q, found, space = blocks[d].search(ids[part], matrix[start : start + QUERY_STEP], probes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[part][q]), pa.array(keys[part][q]), pa.array(found), pa.array(space)],
                        names=["query_id", "query_key", "vec_id", "score"],
                    )

    return run


def _named(rows: DataFrame, number: str, vector: str) -> DataFrame:
    named = rows.select(F.col(number).cast("long").alias("id"), F.col(vector).alias("vector"))
    return named.filter("id IS NOT NULL AND vector IS NOT NULL").withColumn("key", F.xxhash64("id", "vector"))


def search(
    rows: DataFrame,
    queries: DataFrame,
    nearest: int = NEAREST,
    tables: int = TABLES,
    lookups: int = LOOKUPS,
    seed: int = SEED,
    number: str = "vec_id",
    vector: str = "embedding",
    block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of the ``nearest`` rows found for
    each query; ``rows`` and ``queries`` have an id and a vector column of the same names."""
    points, asked = _named(rows, number, vector), _named(queries, number, vector)
    values = points.agg(F.coalesce(F.sum(F.size("vector")), F.lit(0))).first()[0]
    blocks = max(shuffle_count(rows.sparkSession), -(-values // block_values))
    dealt = points.select(F.pmod("key", F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("asked"), "*")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    passed = asked.select(every.alias("block"), F.lit(True).alias("asked"), "*")
    met = dealt.unionByName(passed).repartitionById(blocks, F.col("block"))
    met = met.sortWithinPartitions("asked").select("asked", "id", "key", "vector")
    found = met.mapInArrow(_searcher(nearest, probe_counts(LOOKUP_ROWS, tables, lookups), seed), FOUND).distinct()
    order = Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")
