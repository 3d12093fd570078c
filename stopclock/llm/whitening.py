"""Whitening: projection on the leading components of the covariance, at unit variance.

Sums and covariances are added up over the tasks.  Vectors are whole numbers; each is centred
by the floor of the mean before it is multiplied, and the products are added in whole
numbers, so the covariance does not depend on how rows are dealt or on a task that ran again.

The covariance has as many rows as the vectors have components, whatever the table's size.
The driver brings it to tridiagonal form by Householder reflections, finds the leading
eigenvalues by bisection on Sturm counts and their vectors by inverse iteration, where those
of close eigenvalues are made orthogonal to each other, and reflects them back.  The
components are sent with the tasks that project every row on them.

Results in special cases: null or empty vectors and those that hold a null or non-finite
entry are dropped; where vectors differ in length, those of the most frequent length (the
longest of equals) are kept; an entry of 131,072 or more in size raises an error; rows without
an id, repeated ids and equal rows count row by row; directions without variance cannot be
brought to unit variance and are left out, so equal vectors or a single one give no rows;
empty tables give an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopclock.llm.common import cut
from stopclock.llm.vectors import clean_matrices, scaled

COMPONENTS = 8
SHIFT = 100_000
EPS = float(np.finfo(np.float64).eps)
#: Eigenvalues nearer to each other than this share of the matrix's size are a cluster.
CLUSTER = 1e-3


# --- eigenvectors of a symmetric matrix -----------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder's form: the diagonal, the one beside it, and Q with Q T Q' the matrix."""
    a = np.array(matrix, dtype=np.float64)
    n = len(a)
    q = np.eye(n)
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        size = np.linalg.norm(v)
        if size == 0:
            continue
        v[0] += size if v[0] >= 0 else -size
        v /= np.linalg.norm(v)
        # Two-sided: A - v w' - w v' on what is left of the matrix.
        rest = a[k + 1 :, k + 1 :]
        p = 2 * (rest @ v)
        w = p - (v @ p) * v
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def below(diagonal: np.ndarray, beside: np.ndarray, x: float, tiny: float) -> int:
    """Sturm count: how many eigenvalues are smaller than ``x``."""
    count, pivot = 0, 1.0
    for i in range(len(diagonal)):
        pivot = diagonal[i] - x - (beside[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, beside: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, each bisected to the last bit."""
    n = len(diagonal)
    reach = np.abs(np.concatenate(([0.0], beside))) + np.abs(np.concatenate((beside, [0.0])))
    low, high = float((diagonal - reach).min()), float((diagonal + reach).max())
    size = max(abs(low), abs(high))
    tiny = max(EPS * EPS * size, np.finfo(np.float64).tiny)
    low, high = low - 2 * EPS * size - tiny, high + 2 * EPS * size + tiny
    found = []
    for k in range(min(count, n)):
        a, b = low, high
        while True:
            middle = a + (b - a) / 2
            if middle <= a or middle >= b:
                break
            if below(diagonal, beside, middle, tiny) <= n - 1 - k:
                a = middle
            else:
                b = middle
        found.append(a + (b - a) / 2)
    return np.array(found)


def _solver(diagonal: np.ndarray, beside: np.ndarray, shift: float, tiny: float):
    """Solves (T - shift) x = y by elimination with row exchanges."""
    n = len(diagonal)
    main, up, up2 = diagonal - shift, np.append(beside, 0.0), np.zeros(n)
    steps = []
    for i in range(n - 1):
        low = beside[i]
        if abs(low) > abs(main[i]):
            factor = main[i] / low
            main[i], old = low, up[i]
            up[i], up2[i] = main[i + 1], up[i + 1]
            main[i + 1], up[i + 1] = old - factor * up[i], -factor * up2[i]
            steps.append((factor, True))
        else:
            if abs(main[i]) < tiny:
                main[i] = tiny
            factor = low / main[i]
            main[i + 1] -= factor * up[i]
            steps.append((factor, False))
    if abs(main[-1]) < tiny:
        main[-1] = tiny

    def solve(y: np.ndarray) -> np.ndarray:
        y = y.copy()
        for i, (factor, swapped) in enumerate(steps):
            if swapped:
                y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
            else:
                y[i + 1] -= factor * y[i]
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                y[i] -= up[i] * y[i + 1]
            if i + 2 < n:
                y[i] -= up2[i] * y[i + 2]
            y[i] /= main[i]
        return y

    return solve


def _inverse_iteration(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix, as columns."""
    n = len(diagonal)
    size = max(float(np.abs(diagonal).max()), float(np.abs(beside).max(initial=0.0)), np.finfo(np.float64).tiny)
    tiny = EPS * size
    drawn = np.random.Generator(np.random.PCG64(5))
    out = np.zeros((n, len(values)))
    begin = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * size:
            begin = k
        # Equal eigenvalues are set a hair apart, so that their iterations differ.
        solve = _solver(diagonal, beside, value - (k - begin) * 2 * EPS * size, tiny)
        x = drawn.uniform(-1, 1, n)
        for _ in range(5):
            for _ in range(2):
                x -= out[:, begin:k] @ (out[:, begin:k].T @ x)
            x = solve(x / np.linalg.norm(x))
            x /= np.abs(x).max()
        for _ in range(2):
            x -= out[:, begin:k] @ (out[:, begin:k].T @ x)
        out[:, k] = x / np.linalg.norm(x)
    return out


def leading_components(matrix: np.ndarray, count: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors in rows."""
    diagonal, beside, q = tridiagonal(matrix)
    values = leading_values(diagonal, beside, count)
    vectors = q @ _inverse_iteration(diagonal, beside, values)
    return values, (vectors / np.linalg.norm(vectors, axis=0)).T


# --- passes over the table ------------------------------------------------------------------


def _shifted(batch: pa.RecordBatch, d: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for rows, matrix in clean_matrices(batch.column("vector")):
        if d is None or matrix.shape[1] == d:
            yield rows, scaled(matrix) + SHIFT


def _totals(named: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and sums of their entries, for the most frequent length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for _, x in _shifted(batch):
                now = held.setdefault(x.shape[1], [0, np.zeros(x.shape[1], dtype=np.int64)])
                now[0] += len(x)
                now[1] += x.sum(axis=0)
        for d, (n, s) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d), pa.array(s)],
                names=["d", "at", "n", "s"],
            )

    parts = named.mapInArrow(run, "d int, at int, n bigint, s bigint")
    total = parts.groupBy("d", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    most = total.groupBy("d").agg(F.max("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if most is None:
        return 0, []
    rows = total.filter(F.col("d") == most["d"]).orderBy("at").collect()  # one row per entry
    return most["n"], [r["s"] for r in rows]


def whole_products(x: np.ndarray) -> np.ndarray:
    """x' x of whole numbers, exact; as products of doubles where those are exact as well."""
    most = int(np.abs(x).max(initial=0))
    step = (1 << 53) // max(1, most * most)
    total = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    if step < 1:
        return total + x.T.astype(object) @ x.astype(object)
    for start in range(0, len(x), step):
        part = x[start : start + step].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64)
    return total


def _products(named: DataFrame, middle: list[int]) -> list[list[int]]:
    """Exact sums of the products of entries, each centred by the floor of its mean."""
    d, centre = len(middle), np.array(middle, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), dtype=object)
        for batch in batches:
            for _, x in _shifted(batch, d):
                total = total + whole_products(x - centre)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array([str(v) for v in total[i, j]])],
            names=["i", "j", "s"],
        )

    parts = named.mapInArrow(run, "i int, j int, s string")
    added = parts.groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out = [[0] * d for _ in range(d)]
    for r in added.collect():  # one row per pair of entries
        out[r["i"]][r["j"]] = out[r["j"]][r["i"]] = int(r["s"])
    return out


@dataclass
class Model:
    """What projects a vector: n, sums S, eigenvalues, unit components (rows) and the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float


def fit(named: DataFrame, count: int = COMPONENTS) -> Model | None:
    """Components of ``vector``; None for an empty table."""
    n, sums = _totals(named)
    if not n:
        return None
    middle = [s // n for s in sums]
    left = [s - n * m for s, m in zip(sums, middle, strict=True)]
    products = _products(named, middle)
    # What the floor left of the mean comes off here, still in whole numbers.
    covariance = [
        [float(Fraction(n * p - left[i] * left[j], n * n)) for j, p in enumerate(row)] for i, row in enumerate(products)
    ]
    matrix = np.array(covariance)
    trace = float(np.trace(matrix))
    values, components = leading_components(matrix, count)
    some = values > len(matrix) * EPS * trace
    return Model(n, sums, values[some], components[some], trace)


def project(named: DataFrame, model: Model) -> DataFrame:
    """vec_id, three parts of the deviation and the whitened values (array) of every row."""
    d, n = len(model.sums), model.n
    middle = [s // n for s in model.sums]
    centre, sums = np.array(middle, dtype=np.int64), np.array(model.sums, dtype=np.int64)
    rest = np.array([(s - n * m) / n for s, m in zip(model.sums, middle, strict=True)])
    turned = model.components.T / np.sqrt(model.values)
    size = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _shifted(batch, d):
                values = ((x - centre) - rest) @ turned
                high, low = np.divmod(n * x - sums, 1 << 31)
                upper, lower = np.divmod(low * low, 1 << 31)
                ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * size)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(rows)),
                        pa.array((high * high).sum(axis=1)),
                        pa.array((high * low).sum(axis=1)),
                        pa.array(upper.sum(axis=1)),
                        pa.array(lower.sum(axis=1)),
                        pa.ListArray.from_arrays(ends, pa.array(values.ravel())),
                    ],
                    names=["vec_id", "hh", "hl", "l1", "l0", "whitened"],
                )

    return named.mapInArrow(run, "vec_id bigint, hh bigint, hl bigint, l1 bigint, l0 bigint, whitened array<double>")


def identity_error(rows: DataFrame, n: int, size: int) -> float:
    """Largest entry of the difference between the covariance of ``whitened`` and identity."""

    def each(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("whitened").flatten().to_numpy().reshape(-1, size)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += each(batch).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["at", "s"])

    added = rows.select("whitened").mapInArrow(sums, "at bigint, s double").groupBy("at").agg(F.sum("s").alias("s"))
    mean = np.zeros(size)
    for r in added.collect():
        mean[r["at"]] = r["s"] / n

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            centred = each(batch) - mean
            total += centred.T @ centred
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.ravel())], names=["at", "s"])

    added = rows.select("whitened").mapInArrow(products, "at bigint, s double").groupBy("at").agg(F.sum("s").alias("s"))
    matrix = np.zeros(size * size)
    for r in added.collect():
        matrix[r["at"]] = r["s"] / n
    return float(np.abs(matrix.reshape(size, size) - np.eye(size)).max())


def whiten(vectors: DataFrame, count: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation decimal(38,0), whitened, explained, identity_error: one
    row for each kept vector and component."""
    schema = (
        "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    named = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    model = fit(named, count)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    rows = cut(project(named, model), "whitened")
    error = identity_error(rows, model.n, len(model.values))
    wide = {c: F.col(c).cast("decimal(38,0)") for c in ("hh", "hl", "l1", "l0")}
    deviation = ((wide["hh"] * (1 << 31) + 2 * wide["hl"] + wide["l1"]).cast("decimal(38,0)") * (1 << 31)).cast(
        "decimal(38,0)"
    ) + wide["l0"]
    shares = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
    return rows.select("vec_id", deviation.cast("decimal(38,0)").alias("deviation"), F.posexplode("whitened")).select(
        "vec_id",
        (F.col("pos") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("col").alias("whitened"),
        F.get(shares, F.col("pos")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
