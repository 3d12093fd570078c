"""Text quality by a generalised additive model with pairwise interactions.

Each feature of a text falls into one of its bins; boosting in turn over the features fits a
shallow tree to what the model still misses and adds it, shrunk, to the feature's look-up
table.  The pairs of features with the largest remaining gain then get tables of their own in
the same way.  A score is the sum of table entries through the logistic function.

The model is fitted on at most ``SAMPLE`` labelled rows (the ones of smallest id hash); every
text is scored.  Features come from the text alone.

Results in special cases: a null text counts as empty, and an empty text has a score like
any other; a null doc_id hashes as the empty string; labels that are null are ignored,
several labels of one document count by their mean; without labels of both kinds the score is
their mean, or 0.5 without any; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopclock.llm.common import chunks, texts_of

#: Most labelled rows that the model is fitted on.
SAMPLE = 20_000
#: Bins of a feature, and of each side of a pair.
BINS, PAIR_BINS = 48, 12
#: Rounds over all features and over all pairs, shrinkage, pairs, penalty on leaf values.
ROUNDS, PAIR_ROUNDS, RATE, PAIRS, PENALTY = 120, 60, 0.15, 6, 1.0
#: A document is kept from this score on.
THRESHOLD = 0.3
FOLDS = 5

FEATURES = (
    "log_chars",
    "word_chars",
    "distinct_words",
    "distinct_pairs",
    "distinct_lines",
    "upper",
    "marks",
    "digits",
    "odd_words",
    "single_mark_words",
    "top_word",
    "line_words",
    "letter_kinds",
    "doubled",
)
_ODD = frozenset("#$%&*|<>{}[]\\^~=_@!")


def features(text: str) -> tuple[float, ...]:
    n = len(text)
    words = text.split()
    w = len(words)
    if not w:
        return (float(np.log1p(n)),) + (0.0,) * (len(FEATURES) - 1)
    lowered = [x.lower() for x in words]
    distinct = set(lowered)
    lines = [x for x in text.split("\n") if x]
    odd = single = 0
    for x in distinct:
        if not x.isalpha():
            odd += not _ODD.isdisjoint(x)
            single += len(x) == 1
    kinds = len(set(text))
    upper = sum(x.isupper() for x in words)
    marks = sum(text.count(c) for c in "#$%&*|!<>{}[]")
    digits = sum(text.count(c) for c in "0123456789")
    doubled = sum(a == b for a, b in zip(lowered, lowered[1:]))
    middle = lowered[w // 2]
    return (
        float(np.log1p(n)),
        n / w,
        len(distinct) / w,
        len(set(zip(lowered, lowered[1:]))) / w,
        len(set(lines)) / len(lines),
        upper / w,
        marks / n,
        digits / n,
        odd / len(distinct),
        single / len(distinct),
        max(lowered.count(lowered[0]), lowered.count(middle)) / w,
        w / len(lines),
        kinds / n**0.5,
        doubled / w,
    )


@dataclass
class Model:
    """Look-up tables: ``edges[f]`` are the inner bin edges of feature f, ``tables[f]`` its
    values; ``pairs[k]`` two features, ``pair_edges`` and ``pair_tables`` likewise."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            i = np.searchsorted(self.pair_edges[a], x[:, a], side="right")
            j = np.searchsorted(self.pair_edges[b], x[:, b], side="right")
            total += table[i, j]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="lower"))


def _split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0.0, 0
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + PENALTY) + right_g**2 / (right_h + PENALTY) - g.sum() ** 2 / (h.sum() + PENALTY)
    best = int(np.argmax(gain))
    return float(gain[best]), best + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values of a tree of the given depth over a row of bins."""
    gain, at = _split(g, h)
    if depth == 0 or gain <= 0:
        return np.full(len(g), g.sum() / (h.sum() + PENALTY))
    return np.concatenate((_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)))


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A cut along one side and then one cut of each part along the other, whichever side
    first gains more; the values, and their gain over none."""
    best, best_gain = np.zeros_like(g), -1.0
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        _, at = _split(gg.sum(axis=1), hh.sum(axis=1))
        values, gain = np.zeros_like(gg), 0.0
        for rows in (slice(0, at), slice(at, None)):
            pg, ph = gg[rows].sum(axis=0), hh[rows].sum(axis=0)
            if not len(gg[rows]):
                continue
            leaf = _tree(pg, ph, 1)
            values[rows] = leaf
            gain += float((2 * pg * leaf - (ph + PENALTY / max(1, len(leaf))) * leaf**2).sum())
        if gain > best_gain:
            best, best_gain = (values.T if turned else values), gain
    return best, best_gain


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    if not len(y) or y.min() == y.max():
        rate = min(0.999, max(0.001, float(y.mean()))) if len(y) else 0.5
        return Model(base=float(np.log(rate / (1 - rate))))
    model = Model(base=float(np.log(y.mean() / (1 - y.mean()))))
    model.edges = [_edges(x[:, f], BINS) for f in range(x.shape[1])]
    model.pair_edges = [_edges(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    binned = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    total = np.full(len(y), model.base)

    def gradient() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for f, bins in enumerate(binned):
            g, h = gradient()
            n = len(model.tables[f])
            step = RATE * _tree(np.bincount(bins, g, n), np.bincount(bins, h, n))
            model.tables[f] += step
            total += step[bins]
    coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.pair_edges)]
    sizes = [len(e) + 1 for e in model.pair_edges]
    g, h = gradient()

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[a] * sizes[b] + coarse[b], values, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])

    every = list(combinations(range(x.shape[1]), 2))
    gains = [_pair_tree(grid(a, b, g), grid(a, b, h))[1] for a, b in every]
    model.pairs = [every[i] for i in np.argsort(gains, kind="stable")[::-1][:PAIRS]]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            g, h = gradient()
            step = RATE * _pair_tree(grid(a, b, g), grid(a, b, h))[0]
            model.pair_tables[k] += step
            total += step[coarse[a], coarse[b]]
    return model


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on labelled rows outside fold 0, ``SAMPLE`` at most."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
        .filter((fold(F.col("doc_id")) != 0) & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("double").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE)
    )
    # Sixteen bytes a row and SAMPLE rows at most: a bound that does not grow.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch):
                rows = [features(t) for t in texts_of(piece)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(rows, pa.list_(pa.float64())), piece.column("quality")],
                    names=["doc_id", "x", "y"],
                )

    # One row an id: a repeated id must not make the sample larger.
    rows = texts.mapInArrow(run, "doc_id bigint, x array<double>, y double").groupBy("doc_id")
    sample = rows.agg(F.min("x").alias("x"), F.min("y").alias("y")).orderBy("doc_id").toPandas()
    x = np.array(sample["x"].tolist(), dtype=float).reshape(len(sample), len(FEATURES))
    return fit(x, sample["y"].to_numpy(dtype=float))


def _scored(docs: DataFrame, model: Model, keep_only: bool, out: str | object) -> DataFrame:
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch):
                x = np.array([features(t) for t in texts_of(piece)], dtype=float)
                score = model.score(x)
                if keep_only:
                    yield piece.filter(pa.array(score >= THRESHOLD))
                else:
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"]
                    )

    return docs.select(*(f"`{n}`" for n in names)).mapInArrow(run, out)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row."""
    return _scored(docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text"), model, False, "doc_id bigint, score double")


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold."""
    return _scored(docs, model, True, docs.schema)
