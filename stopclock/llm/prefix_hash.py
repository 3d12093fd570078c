"""Document fingerprints from prefix polynomial hashes.

``Prefix`` keeps the hash of every prefix of a text under two prime moduli.  Two look-ups give
the hash of any span, so span equality takes constant time and the longest common extension
of two places takes a binary search.

A fingerprint is a short string made from such span hashes: the length and the hash of the
whole text, hashes of prefixes and suffixes at a geometric row of lengths, and the smallest
hashes of all spans of ``SPAN`` code points.  Likeness (0 to 1) is the larger of two shares:
how much of the longer text the longest common prefix and suffix cover, found by binary
search over the two rows, and the overlap of the smallest span hashes.

Results in special cases: a null text counts as empty; two empty texts have likeness 1, an
empty and another text 0; equal texts have equal fingerprints and likeness 1.  Rows that
share a doc_id follow each other by text; a single document is its own next one; an empty
table gives an empty result.  Input columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopclock.llm.common import in_id_order, shuffle_count

#: Moduli (the two largest primes below 2**31) and bases of the hashes.
MODULI = ((1 << 31) - 1, (1 << 31) - 19)
BASES = (911_382_323, 972_663_749)
INVERSES = tuple(pow(b, -1, m) for b, m in zip(BASES, MODULI, strict=True))
#: Code points of a sampled span, and how many of the smallest span hashes are kept.
SPAN, KEPT = 24, 24

_powers = [np.ones(1, dtype=np.uint64) for _ in MODULI]


def powers(k: int, n: int) -> np.ndarray:
    """Powers 0 to n of base k, grown by doubling and kept for the next text."""
    have = _powers[k]
    while len(have) <= n:
        step = np.uint64(pow(BASES[k], len(have), MODULI[k]))
        have = np.concatenate((have, have * step % np.uint64(MODULI[k])))
    _powers[k] = have if len(have) <= 1 << 22 else have[: 1 << 22]
    return have[: n + 1]


class Prefix:
    """Prefix hashes of one text: ``sums[k][i]`` is the sum of (code point + 1) * base**j over
    j < i, modulo the k-th modulus."""

    def __init__(self, text: str):
        self.text = text
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        self.n = len(points)
        self.sums = []
        for k, m in enumerate(MODULI):
            terms = points * powers(k, self.n)[: self.n]
            sums = np.zeros(self.n + 1, dtype=np.uint64)
            # A term is below 2**52, so thousands of them can be added before a reduction.
            if self.n > 1 << 11:
                terms %= np.uint64(m)
            np.cumsum(terms, out=sums[1:])
            sums %= np.uint64(m)
            self.sums.append(sums)

    @classmethod
    def edited(cls, one: Prefix, two: Prefix) -> Prefix:
        """Of ``edited(one.text, two.text)``: the sums of the kept half, then those of the new
        half shifted by one power."""
        new = cls.__new__(cls)
        new.text = edited(one.text, two.text)
        new.n = len(new.text)
        keep = one.n - one.n // 2
        new.sums = []
        for k, m in enumerate(MODULI):
            sums = np.empty(new.n + 1, dtype=np.uint64)
            sums[: keep + 1] = one.sums[k][: keep + 1]
            tail = sums[keep + 1 :]
            np.multiply(two.sums[k][1 : new.n - keep + 1], powers(k, keep)[keep], out=tail)
            tail += sums[keep]
            tail %= np.uint64(m)
            new.sums.append(sums)
        return new

    def spans(self, starts: np.ndarray, ends: np.ndarray, top: int | None = None) -> np.ndarray:
        """Hashes (62 bits) of the spans.  They are brought to the common power ``top``, at
        least as large as every start; hashes of one ``top`` can be compared."""
        top = self.n if top is None else top
        out = np.zeros(len(starts), dtype=np.uint64)
        for k, m in enumerate(MODULI):
            m = np.uint64(m)
            raw = (self.sums[k][ends] + m - self.sums[k][starts]) % m
            out = (out << np.uint64(31)) | (raw * powers(k, top)[top - starts] % m)
        return out

    def equal(self, i: int, other: Prefix, j: int, size: int) -> bool:
        """Whether ``size`` code points from i equal those of ``other`` from j."""
        if i + size > self.n or j + size > other.n:
            return False
        top = max(self.n, other.n)
        one, two = np.array([i]), np.array([j])
        return bool(self.spans(one, one + size, top)[0] == other.spans(two, two + size, top)[0])

    def extension(self, i: int, other: Prefix, j: int) -> int:
        """How many code points from i and from j on are the same, by binary search."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal(i, other, j, middle) else (low, middle - 1)
        return low


_lengths = [1]


def _row(n: int) -> np.ndarray:
    """Lengths from 1 up to n, each about a sixteenth more than the one before."""
    while _lengths[-1] <= n:
        _lengths.append(_lengths[-1] + max(1, _lengths[-1] // 16))
    return np.array(_lengths[: bisect_right(_lengths, n)], dtype=np.int64)


def fingerprint(text: str) -> str:
    """``length;whole;prefixes;suffixes;spans``: hexadecimal, eight digits a hash in the last
    three."""
    return fingerprint_of(Prefix(text))


def fingerprint_of(p: Prefix) -> str:
    if not p.n:
        return "0;0;;;"
    row = _row(p.n)
    front = (p.sums[0][row] << np.uint64(31)) | p.sums[1][row]
    # A suffix hash must not depend on where the text ends: the power of its end is fixed.
    back = []
    for k, m in enumerate(MODULI):
        raw = (p.sums[k][-1] + np.uint64(m) - p.sums[k][p.n - row]) % np.uint64(m)
        back.append(raw * np.uint64(pow(INVERSES[k], p.n, m)) % np.uint64(m))
    back = (back[0] << np.uint64(31)) | back[1]
    size = min(SPAN, p.n)
    kept = _smallest(_placeless(p, p.n - size + 1, size))
    whole = int(p.sums[0][-1]) << 31 | int(p.sums[1][-1])
    return f"{p.n:x};{whole:x};{_hex(front)};{_hex(back)};{_hex(kept)}"


def _hex(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()  # the low 32 bits


def _smallest(values: np.ndarray) -> np.ndarray:
    """The ``KEPT`` smallest distinct values, without sorting them all."""
    k = 4 * KEPT
    while True:
        found = np.unique(np.partition(values, k)[:k] if k < len(values) else values)
        if len(found) >= KEPT or k >= len(values):
            return found[:KEPT]
        k *= 8


def _placeless(p: Prefix, n: int, size: int) -> np.ndarray:
    """Hashes of the first ``n`` spans of one size that do not depend on their starts (first modulus only),
    mixed so that the smallest ones are a fair sample."""
    mod, sums = np.uint64(MODULI[0]), p.sums[0]
    raw = sums[size : size + n] + mod - sums[:n]
    raw %= mod
    raw *= _inverse_powers(0, n)
    raw %= mod
    raw *= np.uint64(0x9E3779B97F4A7C15)
    return raw >> np.uint64(32)


_inverses = [np.ones(1, dtype=np.uint64) for _ in MODULI]


def _inverse_powers(k: int, n: int) -> np.ndarray:
    have = _inverses[k]
    while len(have) < n:
        step = np.uint64(pow(INVERSES[k], len(have), MODULI[k]))
        have = np.concatenate((have, have * step % np.uint64(MODULI[k])))
    _inverses[k] = have if len(have) <= 1 << 22 else have[: 1 << 22]
    return have[:n]


def _common(a: str, b: str) -> int:
    """How many leading hashes of two rows agree, by binary search: once prefixes differ,
    all longer ones do."""
    low, high = 0, min(len(a), len(b)) // 8
    while low < high:
        middle = (low + high + 1) // 2
        at = slice(8 * middle - 8, 8 * middle)
        low, high = (middle, high) if a[at] == b[at] else (low, middle - 1)
    return low


def likeness(one: str, two: str) -> float:
    """Likeness of the texts of two fingerprints, 0 to 1."""
    if one == two:
        return 1.0
    (n, _, front, back, spans), (m, _, front2, back2, spans2) = one.split(";"), two.split(";")
    n, m = int(n, 16), int(m, 16)
    if not n or not m:
        return 0.0
    shared = 0
    for x, y in ((front, front2), (back, back2)):
        k = _common(x, y)
        shared += int(_row(min(n, m))[k - 1]) if k else 0
    covered = min(shared, min(n, m)) / max(n, m)
    a, b = ({s[i : i + 8] for i in range(0, len(s), 8)} for s in (spans, spans2))
    smallest = sorted(a | b)[:KEPT]
    overlap = sum(x in a and x in b for x in smallest) / len(smallest)
    return min(1.0, max(covered, overlap))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many first code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


FIELDS = "doc_id bigint, n_chars bigint, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text and likeness to it and to the next
    document's, by ascending doc_id; the last one is followed by the first.

    Rows are dealt once into ranges of doc_id and streamed in order.  Only the first
    document of each range travels twice, to end the range before it.
    """
    spark = docs.sparkSession
    parts = shuffle_count(spark)
    rows, heads = in_id_order(docs, parts)
    rows = rows.withColumn("head", F.lit(0))
    if heads:
        after = [(p, heads[(i + 1) % len(heads)][1]) for i, (p, _) in enumerate(heads)]
        ends = spark.createDataFrame(after, "part int, first bigint")
        first = rows.drop("part").join(F.broadcast(ends), F.col("doc_id").eqNullSafe(F.col("first")))
        # Of rows with the same id the smallest text comes first; one a range is enough.
        first = first.groupBy("part").agg(F.min_by("doc_id", "text").alias("doc_id"), F.min("text").alias("text"))
        rows = rows.select("part", "doc_id", "text", "head").union(
            first.select("part", "doc_id", "text", F.lit(1))
        )
    ordered = rows.repartitionById(parts, "part").sortWithinPartitions("part", "head", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out, weight = None, [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "doc_id", "text", "head"))
            for part, doc_id, text, head in zip(*columns, strict=True):
                prefix = Prefix(text)
                mark = fingerprint_of(prefix)
                if held is not None and held[0] == part:
                    _, own_id, own, own_mark = held
                    other = Prefix.edited(own, prefix)
                    changed_mark = fingerprint_of(other)
                    out.append(
                        (
                            own_id,
                            own.n,
                            other.text,
                            own_mark,
                            changed_mark,
                            likeness(own_mark, changed_mark),
                            likeness(own_mark, mark),
                        )
                    )
                    weight += other.n
                held = None if head else (part, doc_id, prefix, mark)
                if weight > 1 << 22:
                    yield _batch(out)
                    out, weight = [], 0
        if out:
            yield _batch(out)

    return ordered.select("part", "doc_id", "text", "head").mapInArrow(run, FIELDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [f.split()[0] for f in FIELDS.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
    )
