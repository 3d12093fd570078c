"""SimHash fingerprints and the pairs of them that differ in few bits.

A fingerprint's 64 bits are cut into 16 segments that stand in a ring.  If two fingerprints
differ in ``radius`` bits at most, then from some segment on every chain of consecutive
segments stays within its share of the radius (the pigeonring principle).  The longest chain
whose share is no bit at all, with one half of the chain whose share is one bit, is an exact
key of 30 bits for a radius of 3; fingerprints that meet under a key must pass the chain's
growing budgets before their whole distance is taken.

Only distinct fingerprints are compared.  A key under which too many meet is not compared at
once: its rows go round again under longer keys, each with a further quarter of the free bits
(one quarter at least holds no difference if there are three in all), which is exact.

Results in special cases: a null text counts as empty; a text without words has fingerprint 0
and is linked like any other; equal texts, repeated rows and rows with equal fingerprints
share a component; a null doc_id never names a component unless all ids in it are null; an
empty table gives an empty result.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopclock.llm.common import chunks, cut, shuffle_count, split_by, texts_of
from stopclock.llm.graph import components

SEED = 42
SEGMENTS = 16
WIDTH = 64 // SEGMENTS
#: Fingerprints that are compared at once under one key.
MOST = 4096


def words_of(text: str) -> list[bytes]:
    """ASCII letters lowered, cut at ASCII white space."""
    return text.encode().lower().split()


def shingles(words: list[bytes], size: int) -> list[int]:
    """Hashes of the shingles in order; fewer words than ``size`` make one, none make none."""
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(line, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = [0, *(ends[: len(words) - size] + 1).tolist()]
    h = xxhash.xxh64_intdigest
    return [h(line[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)]


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of some hashes: bits that are set in more than half of them."""
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.unpackbits(hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view(">u8")[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed number) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch):
                marks = [
                    majority(np.array(shingles(words_of(t), size), dtype=np.uint64)) for t in texts_of(piece)
                ]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(np.array(marks, dtype=np.uint64).view(np.int64))],
                    names=["doc_id", "fp"],
                )

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(run, "doc_id bigint, fp bigint")


def _chain(share: int, radius: int) -> int:
    """The longest chain whose budget is ``share`` bits."""
    return max(n for n in range(SEGMENTS + 1) if n * radius // SEGMENTS <= share)


def _ring(start: int, length: int) -> int:
    """Mask of ``length`` bits from bit ``start`` (from the left) on, round the ring."""
    mask = 0
    for i in range(length):
        mask |= 1 << (63 - (start + i) % 64)
    return mask


def key_masks(radius: int) -> list[int]:
    """Masks of the first keys, two for each start of a chain."""
    exact = _chain(0, radius) * WIDTH
    rest = min(_chain(1, radius), SEGMENTS) * WIDTH - exact
    out = []
    for s in range(SEGMENTS):
        first = _ring(s * WIDTH, exact)
        half = rest // 2
        out += [
            first | _ring(s * WIDTH + exact, half),
            first | _ring(s * WIDTH + exact + half, rest - half),
        ]
    return out


def longer_masks(masks: list[int], radius: int) -> list[int]:
    """For each mask, ``radius`` + 1 that each add one part of its free bits."""
    out = []
    for mask in masks:
        free = [b for b in range(64) if not mask >> b & 1]
        for part in range(radius + 1):
            out.append(mask | sum(1 << b for b in free[part :: radius + 1]))
    return out


@lru_cache(1 << 16)
def mask_of(j: int, longer: int, radius: int) -> int:
    """Mask ``j`` of those that ``longer`` rounds of ``longer_masks`` make of the first ones."""
    if not longer:
        return key_masks(radius)[j]
    return longer_masks([mask_of(j // (radius + 1), longer - 1, radius)], radius)[j % (radius + 1)]


def _longer_keys(longer: int, radius: int):
    """Rows (f, j) of the round before, to (j, f, part) of their masks of this round.  A task
    makes the masks of its own rows: their number grows with each round, the plan does not."""
    fan = radius + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f, j = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("f", "j"))
            js, which = np.unique(j, return_inverse=True)
            before = [mask_of(i, longer - 1, radius) for i in js.tolist()]
            masks = np.array(longer_masks(before, radius), dtype=np.uint64).reshape(-1, fan)
            for k in range(fan):
                part = f.view(np.uint64) & masks[which, k]
                own = pa.array(j.astype(np.int64) * fan + k, pa.int32())  # an error beyond 32 bits
                columns = [own, pa.array(f), pa.array(part.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["j", "f", "part"])

    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _within(a: np.ndarray, b: np.ndarray, start: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs keep to the chain's budgets from their start on, and then to the radius."""
    x = a ^ b
    turn = (start * WIDTH).astype(np.uint64)
    x = (x << turn) | (x >> ((np.uint64(64) - turn) % np.uint64(64)))
    good = np.ones(len(x), dtype=bool)
    for share in range(1, radius):
        top = np.uint64(64 - _chain(share, radius) * WIDTH)
        good[good] = np.bitwise_count(x[good] >> top) <= share
    good[good] = np.bitwise_count(x[good]) <= radius
    return good


def _linked(f: np.ndarray, run: np.ndarray, start: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint and the first one of its run that it is connected with, where these
    differ.  ``run`` numbers the runs of one key; runs lie together."""
    n = len(f)
    label = np.arange(n)
    lefts, rights = [], []
    left = np.arange(n)
    for step in range(1, n):
        left = left[left + step < n]
        left = left[run[left] == run[left + step]]
        if not len(left):
            break
        good = left[_within(f[left], f[left + step], start[left], radius)]
        lefts.append(good)
        rights.append(good + step)
    if not lefts:
        return f[:0], f[:0]
    a, b = np.concatenate(lefts), np.concatenate(rights)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(n))
    return f[moved], f[label[moved]]


def _comparer(radius: int, most: int, fan: int):
    """Rows (key, j, f) sorted by key, to edges (u, v) and to rows (u, null, j) of the keys
    under which more than ``most`` meet.  ``fan`` masks belong to each start of a chain."""

    def out(u: np.ndarray, v: np.ndarray | None, j: np.ndarray | None) -> pa.RecordBatch:
        columns = [pa.array(u, pa.int64())]
        for x, kind in ((v, pa.int64()), (j, pa.int32())):
            columns.append(pa.nulls(len(u), kind) if x is None else pa.array(x, kind))
        return pa.RecordBatch.from_arrays(columns, names=["u", "v", "j"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, wide = None, None  # rows of a run that may go on; the key of one passed on so far
        for batch in batches:
            key, j, f = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "j", "f"))
            if held is not None:
                key, j, f = (np.concatenate(x) for x in zip(held, (key, j, f), strict=True))
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if len(key) - last > most:
                last = len(key)  # enough to know that it is passed on, whatever follows
            held = (key[last:], j[last:], f[last:]) if last < len(key) else None
            yield from settle(key[:last], j[:last], f[:last], wide)
            if last and len(key) == last:
                wide = key[-1]
        if held is not None:
            yield from settle(*held, wide)

    def settle(key: np.ndarray, j: np.ndarray, f: np.ndarray, wide) -> Iterator[pa.RecordBatch]:
        if not len(key):
            return
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(begin, append=len(key))
        hot = size > most
        hot[0] |= wide is not None and key[0] == wide
        run_of = np.repeat(np.arange(len(begin)), size)
        many = hot[run_of]
        if many.any():
            yield out(f[many], None, j[many])
        some = (size[run_of] > 1) & ~many
        if some.any():
            u, v = _linked(f[some].view(np.uint64), run_of[some], j[some] // fan, radius)
            if len(u):
                yield out(u.view(np.int64), v.view(np.int64), None)

    return run


def links(distinct: DataFrame, radius: int = 3, most: int = MOST) -> DataFrame:
    """Edges u, v that connect all fingerprints (column ``fp``, distinct) within ``radius``
    bits of each other; of a group that meets under one key only a spanning forest."""
    spark = distinct.sparkSession
    longer, fan, found = 0, 2, None
    parts = F.array(*(F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in key_masks(radius)))
    keyed = distinct.select(F.col("fp").alias("f"), F.posexplode(parts).alias("j", "part"))
    while True:
        keyed = keyed.select(F.xxhash64("j", "part").alias("key"), "j", "f")
        ordered = keyed.repartition(shuffle_count(spark), "key").sortWithinPartitions("key", "f")
        result = cut(ordered.mapInArrow(_comparer(radius, most, fan), "u bigint, v bigint, j int"), "simhash-links")
        edges = result.filter("v IS NOT NULL").select("u", "v")
        found = edges if found is None else found.union(edges)
        again = result.filter("v IS NULL").select(F.col("u").alias("f"), "j").distinct()
        if again.isEmpty():
            return found
        longer, fan = longer + 1, fan * (radius + 1)
        keyed = again.mapInArrow(_longer_keys(longer, radius), "j int, f bigint, part bigint")


def connected(marks: DataFrame, radius: int = 3) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id that links lead to."""
    marks = cut(marks.select("doc_id", "fp"), "simhash")
    least = marks.groupBy("fp").agg(F.min("doc_id").alias("least"))
    least = cut(least, "simhash-distinct")
    groups = components(links(least.select("fp"), radius))
    groups = cut(groups, "simhash-groups")
    known = least.join(groups, F.col("fp") == F.col("node"), "left")
    known = known.select("fp", "least", F.coalesce("component", "fp").alias("group"))
    ids = known.groupBy("group").agg(F.min("least").alias("component_id"))
    ids = known.join(ids, "group").select("fp", "component_id")
    return marks.join(ids, "fp").select("doc_id", "fp", "component_id")


# --- texts that are alike ---------------------------------------------------------------

#: Shingle length and least similarity of near duplicates.
ALIKE_WORDS, SIMILARITY = 5, 0.8
#: Samples of a text's shingles and shingles in each.  A place of a sample is the shingle that
#: comes first in an order of its own, which two texts have in common with a chance equal to
#: their similarity, wherever the difference lies: of two texts that are 0.8 alike no sample
#: agrees with chance (1 - 0.8**4)**30, about 1 in 7 million.
SAMPLES, SAMPLE_SHINGLES = 30, 4
#: Texts of one candidate group that are compared in one task.
TOGETHER = 512

_DRAWN = np.random.Generator(np.random.PCG64(SEED)).integers(0, 1 << 64, (2, SAMPLES * SAMPLE_SHINGLES, 1), np.uint64)
_SALT, _ODD = _DRAWN[0], _DRAWN[1] | np.uint64(1)


def sampled(hashes: np.ndarray) -> list[int]:
    """Hashes of the samples of a text's shingles, as signed numbers."""
    if not len(hashes):
        return []
    first = np.full(SAMPLES * SAMPLE_SHINGLES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), 4096):
        mixed = (hashes[i : i + 4096] ^ _SALT) * _ODD
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xC2B2AE3D27D4EB4F)
        np.minimum(first, mixed.min(axis=1), out=first)
    rows = first.astype("<u8").reshape(SAMPLES, SAMPLE_SHINGLES)
    return [_signed(xxhash.xxh64_intdigest(row.tobytes(), SEED)) for row in rows]


def _text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def _candidates(texts: DataFrame, radius: int) -> DataFrame:
    """key, candidate: groups of texts (key, fp, samples) that links of fingerprints connect.

    Texts are linked if their fingerprints are within ``radius`` bits, or a sample of theirs
    is the same.  Numbers that meet by chance only make a group larger; it is compared anyway.
    """
    nodes = texts.select(F.xxhash64("key").alias("node"), "fp", "samples")
    least = cut(nodes.groupBy("fp").agg(F.min("node").alias("m")), "alike-fps")
    same = nodes.join(least, "fp").filter("node <> m").select(F.col("node").alias("u"), F.col("m").alias("v"))
    near = (
        links(least.select("fp"), radius)
        .join(least.select(F.col("fp").alias("u"), F.col("m").alias("mu")), "u")
        .join(least.select(F.col("fp").alias("v"), F.col("m").alias("mv")), "v")
        .select("mu", "mv")
    )
    drawn = nodes.select("node", F.posexplode("samples").alias("t", "s"))
    drawn = drawn.select("node", F.xxhash64("t", "s").alias("s"))
    shared = drawn.groupBy("s").agg(F.min("node").alias("m"), F.max("node").alias("top")).filter("m < top")
    drawn = drawn.join(shared, "s").filter("node <> m").select("node", "m")
    groups = components(same.union(near).union(drawn))
    return texts.select("key", F.xxhash64("key").alias("node")).join(groups, "node").select(
        "key", F.col("component").alias("candidate")
    )


def alike(sets: list[np.ndarray]) -> np.ndarray:
    """Which pairs of distinct-hash arrays have a Jaccard similarity of at least
    ``SIMILARITY``, as a matrix.  Only hashes that two arrays have are counted, in blocks."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    used = count[place] > 1
    owner, column = owner[used], number[place[used]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((n, n), dtype=np.float32)
    width = max(64, (1 << 21) // n)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (start, start + width))
        block = np.zeros((n, width), dtype=np.float32)
        block[owner[a:b], column[a:b] - start] = 1
        both += block @ block.T
    union = sizes[:, None] + sizes[None, :] - both
    return (both >= np.float32(SIMILARITY) * union - 1e-4) & (both > 0)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (candidate, a, b, own, key, hashes) sorted by group to edges u, v between keys:
    in group (a, b) the texts of part a are compared with those of part b."""

    def edges(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        good = alike([r[2] for r in rows])
        part = np.array([r[0] for r in rows])
        if part.min() != part.max():
            good &= part[:, None] != part[None, :]
        u, v = np.nonzero(np.triu(good, 1))
        label = np.arange(len(rows))
        while len(u):
            before = label.copy()
            low = np.minimum(label[u], label[v])
            np.minimum.at(label, u, low)
            np.minimum.at(label, v, low)
            label = label[label]
            if (label == before).all():
                break
        moved = np.flatnonzero(label != np.arange(len(rows))).tolist()
        if moved:
            keys = [r[1] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in moved]), pa.array([keys[label[i]] for i in moved])], names=["u", "v"]
            )

    group, rows = None, []
    for batch in batches:
        ids = zip(*(batch.column(c).to_pylist() for c in ("candidate", "a", "b", "own", "key")), strict=True)
        ends, values = np.asarray(batch.column("hashes").offsets), batch.column("hashes").values
        for i, (*now, own, key) in enumerate(ids):
            if now != group:
                if len(rows) > 1:
                    yield from edges(rows)
                group, rows = now, []
            rows.append((own, key, values.slice(ends[i], ends[i + 1] - ends[i]).to_numpy().copy()))
    if len(rows) > 1:
        yield from edges(rows)


def near_groups(docs: DataFrame, radius: int = 3, together: int = TOGETHER) -> DataFrame:
    """doc_id, key (of the text), group_id of every row: groups of texts that are equal or
    connected by pairs with a similarity of at least ``SIMILARITY`` of their word shingles.

    Links between fingerprints propose groups of texts, far fewer than all; inside a group
    every pair is compared exactly, in tasks of at most two parts of ``together`` texts.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_key(F.col("text")).alias("key"))

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch):
                each = [words_of(t) for t in texts_of(piece)]
                fps = [majority(np.array(shingles(w, 3), dtype=np.uint64)) for w in each]
                drawn = [sampled(np.array(shingles(w, ALIKE_WORDS), dtype=np.uint64)) for w in each]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("key"),
                        pa.array(np.array(fps, dtype=np.uint64).view(np.int64)),
                        pa.array(drawn, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "key", "fp", "samples"],
                )

    schema = "doc_id bigint, key string, fp bigint, samples array<bigint>"
    rows = cut(docs.mapInArrow(marks, schema), "alike-marks")
    texts = rows.groupBy("key").agg(
        F.min("doc_id").alias("least"), F.min("fp").alias("fp"), F.min("samples").alias("samples")
    )
    texts = cut(texts, "alike-texts")
    proposed = cut(_candidates(texts, radius), "alike-candidates")
    parts = F.ceil(F.count("*") / together).cast("int")
    sizes = proposed.groupBy("candidate").agg(parts.alias("parts"), F.count("*").alias("n")).filter("n > 1")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch):
                sets = [np.unique(np.array(shingles(words_of(t), ALIKE_WORDS), dtype=np.uint64)) for t in texts_of(piece)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(piece.column(c) for c in ("candidate", "parts", "key")),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["candidate", "parts", "key", "hashes"],
                )

    proposed = cut(proposed.join(sizes, "candidate"), "alike-proposed")
    # Most texts are in no group: they stay where they are.
    grouped, _ = split_by(docs, F.xxhash64("key"), proposed, F.xxhash64("key"))
    members = grouped.join(proposed, "key").join(texts.select("key", "least"), "key")
    members = members.filter(F.col("doc_id").eqNullSafe(F.col("least"))).select("candidate", "parts", "key", "text")
    members = members.mapInArrow(hashes, "candidate bigint, parts int, key string, hashes array<bigint>")
    # The text of one id may be stored several times; one of each is compared.
    members = cut(members.dropDuplicates(["key"]), "alike-members")
    own = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select(
        "candidate", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "key", "hashes"
    )
    ordered = dealt.repartition(shuffle_count(spark), "candidate", "a", "b").sortWithinPartitions("candidate", "a", "b")
    groups = components(ordered.mapInArrow(_compare, "u string, v string"))
    groups = cut(groups, "alike-groups")
    known = texts.join(groups, F.col("key") == F.col("node"), "left").select(
        "key", "least", F.coalesce("component", "key").alias("group")
    )
    ids = known.groupBy("group").agg(F.min("least").alias("group_id"))
    known = known.join(ids, "group").select("key", "group_id")
    return rows.select("doc_id", "key").join(known, "key").select("doc_id", "key", "group_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with the row of the smallest doc_id of each group.  Rows that
    share this doc_id and their group stay together."""
    groups = near_groups(docs)
    gone = groups.filter(~F.col("doc_id").eqNullSafe(F.col("group_id")))
    gone = cut(gone.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct(), "alike-gone")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (_text_key(docs["text"]) == F.col("__key"))
    maybe, rest = split_by(docs, F.xxhash64(_text_key(docs["text"])), gone, F.xxhash64("__key"))
    return rest.union(maybe.join(gone, same, "left_anti"))
