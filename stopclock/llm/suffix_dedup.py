"""Removal of repeated byte strings, exact, by suffix arrays over shards of the corpus.

A string of ``LENGTH`` bytes counts as repeated if it starts at two places anywhere.  Every
window of that length picks an anchor, its ``GRAM``-byte piece of smallest hash: equal
windows pick the same piece, so windows that could be equal share an anchor.  Stretches of
windows around one anchor (snippets) are counted by content first; only where one anchor has
several contents are their bytes gathered.  A shard of anchors gets one suffix array, by
Larsson-Sadakane refinement (groups that are not yet sorted by depth d are sorted by the rank
of what starts d bytes on, which doubles the depth), and Kasai's common prefixes between
neighbours; windows whose neighbour shares ``LENGTH`` bytes are repeated.

An anchor of very many contents is dealt over several shards.  Each of these also sends the
sorted hashes of its windows, cut into ranges, and the ranges of all its shards are merged by
binary search.

Results in special cases: a null text counts as empty; texts shorter than ``LENGTH`` keep all
bytes; repeated rows are separate documents, so all their windows are repeated; a null
doc_id is kept; an empty table gives an empty result.  Columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopclock.llm.common import chunks, cut, shuffle_count

LENGTH, GRAM = 200, 32
#: Bytes of snippets that one suffix array takes, and contents of one anchor in one shard.
SHARD_BYTES, SHARD_CONTENTS = 1 << 20, 2048
#: Window hashes in one range of a cross-shard merge, about.
RANGE = 1 << 18
#: Bytes of a text that are scanned at a time (positions must fit 20 bits).
SCAN = (1 << 20) - LENGTH

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_S = np.uint64(29)


def _join(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Hashes of two pieces that follow each other, from the pieces' hashes."""
    h = (a ^ (a >> _S)) * _M[k] + b
    h ^= h >> _S
    return h * _M[2]


def window_hashes(data: np.ndarray, k: int = 0, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all ``GRAM``-byte pieces and of all windows of ``length`` bytes."""
    h, size, gram = (data.astype(np.uint64) + _M[2 - k]) * _M[k], 1, None
    while size * 2 <= length:
        h = _join(h[:-size], h[size:], k)
        size *= 2
        if size == GRAM:
            gram = h
    n = len(data) - length + 1
    return gram, h[:n] if size == length else _join(h[:n], h[length - size : length - size + n], k)


def _anchors(gram: np.ndarray, windows: int) -> np.ndarray:
    """For each window the place of its smallest piece, the first of equals."""
    reach = LENGTH - GRAM + 1
    packed = ((gram * _M[0]) >> np.uint64(20) << np.uint64(20)) | np.arange(len(gram), dtype=np.uint64)
    size = 1
    while size * 2 <= reach:
        packed = np.minimum(packed[:-size], packed[size:])
        size *= 2
    packed = np.minimum(packed[:windows], packed[reach - size : reach - size + windows])
    return (packed & np.uint64((1 << 20) - 1)).astype(np.int64)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of true."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def scan(text: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of one text: columns (anchor, low, high, content) of its snippets, by their first and
    last windows, and columns (start, end) of the bytes that windows cover which occur again
    in the text itself."""
    n = len(text) - LENGTH + 1
    if n <= 0:
        return [np.zeros(0, np.int64)] * 4, [np.zeros(0, np.int64)] * 2
    data = np.frombuffer(text, dtype=np.uint8)
    place, anchor, windows = [], [], []
    for at in range(0, n, SCAN):
        part = data[at : at + SCAN + LENGTH - 1]
        gram, whole = window_hashes(part)
        near = _anchors(gram, len(whole))
        place.append(near + at)
        anchor.append(gram[near])
        windows.append(whole)
    place, anchor, windows = (np.concatenate(x) for x in (place, anchor, windows))
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    again = np.zeros(n, dtype=bool)
    again[order[1:][same]] = True  # not the first of its kind: need not be looked for
    twice = again.copy()
    twice[order[:-1][same]] = True
    first = np.flatnonzero(~again)
    heads = np.flatnonzero(np.append(True, place[first][1:] != place[first][:-1]))
    low, high = first[heads], first[np.append(heads[1:], len(first)) - 1]
    content = [xxhash.xxh64_intdigest(text[a : b + LENGTH], 7) for a, b in zip(low.tolist(), high.tolist())]
    starts, ends = _runs(twice)
    return (
        [anchor[low].view(np.int64), low, high, np.array(content, dtype=np.uint64).view(np.int64)],
        [starts, ends + LENGTH],
    )


ROW = "doc_id bigint, th bigint"
_SNIPPETS = f"{ROW}, anchor bigint, low bigint, high bigint, content bigint"


def _snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Snippets; a null anchor marks bytes (low, high) that the text itself repeats."""
    for batch in batches:
        for piece in chunks(batch):
            columns, owner = [], []
            for i, text in enumerate(piece.column("text").to_pylist()):
                found, own = scan(text.encode())
                columns.append([*found, np.ones(len(found[0]), dtype=bool)])
                zero = np.zeros(len(own[0]), dtype=np.int64)
                columns.append([zero, *own, zero, zero.astype(bool)])
                owner += [np.full(len(found[0]), i), np.full(len(own[0]), i)]
            anchor, low, high, content, real = (np.concatenate(c) for c in zip(*columns, strict=True))
            at = pa.array(np.concatenate(owner))
            yield pa.RecordBatch.from_arrays(
                [
                    *(piece.column(c).take(at) for c in ("doc_id", "th")),
                    pa.array(anchor, pa.int64(), mask=~real),
                    *(pa.array(x, pa.int64()) for x in (low, high, content)),
                ],
                names=["doc_id", "th", "anchor", "low", "high", "content"],
            )


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Order of all suffixes.  Code 0 ends a piece; of two ends the earlier is the smaller, so
    no two suffixes are equal."""
    n = len(codes)
    padded = np.concatenate((codes.astype(np.int64), np.zeros(3, np.int64)))
    key, ended = np.zeros(n, np.int64), np.zeros(n, bool)
    for i in range(4):
        ended |= padded[i : i + n] == 0
        key = key << 9 | np.where(ended, 0, padded[i : i + n])
    # One number sorts by both: four codes have 36 bits, and a shard far less than 2**27 places.
    key = key << 27 | np.where(ended, np.arange(n), 0)
    sa = np.argsort(key)
    new = np.append(True, key[sa][1:] != key[sa][:-1])
    rank = np.zeros(2 * n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h = 4
    while True:
        open_ = np.flatnonzero(~(new & np.append(new[1:], True)))  # groups not yet sorted
        if not len(open_):
            return sa
        at = sa[open_]
        group, then = rank[at], rank[at + h]
        pair = group << 27 | then
        order = np.argsort(pair)
        sa[open_] = at[order]
        pair = pair[order]
        new[open_] = np.append(True, pair[1:] != pair[:-1])
        firsts = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[sa[open_]] = firsts[open_]
        h *= 2


def common_prefixes(text: bytes, sa: np.ndarray, windows: np.ndarray, most: int) -> np.ndarray:
    """Kasai: for the suffixes in ``sa`` order that are ``windows`` (flags by place), the
    length, up to ``most``, that each shares with the one before it."""
    kept = sa[windows[sa]]
    before = np.full(len(text), -1, np.int64)
    before[kept[1:]] = kept[:-1]
    before, flags, shared, h = before.tolist(), windows.tolist(), np.zeros(len(text), np.int64), 0
    last, last_j, found = -2, -2, []
    places = np.flatnonzero(windows)
    for i in places.tolist():
        j = before[i]
        # What the place before this one shared, less one, holds if both can go one on.
        if i != last + 1 or last_j < 0 or not flags[last_j + 1]:
            h = 0
        if j >= 0:
            # Nearly all windows that share much share ``most``: one comparison tells.
            if text[i + h : i + most] == text[j + h : j + most]:
                h = most
            else:
                while text[i + h : i + h + 16] == text[j + h : j + h + 16]:
                    h += 16
                while text[i + h] == text[j + h]:
                    h += 1
            found.append(h)
            h = h - 1 if h else 0
        else:
            found.append(0)
            h = 0
        last, last_j = i, j
    shared[places] = found
    return shared[kept]


def repeated_windows(pieces: list[bytes], counts: list[int]) -> list[np.ndarray]:
    """For each piece a flag for each of its windows: whether that string occurs again in any
    piece, or the piece stands for several equal ones."""
    text = b"\0".join(pieces) + b"\0"
    codes = np.frombuffer(text, dtype=np.uint8).astype(np.int16) + 1
    ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
    codes[ends] = 0
    starts = np.concatenate(([0], ends[:-1] + 1))
    windows = np.zeros(len(text), dtype=bool)
    for a, b in zip(starts.tolist(), ends.tolist()):
        windows[a : b - LENGTH + 1] = True
    sa = suffix_array(codes)
    shared = common_prefixes(text, sa, windows, LENGTH)
    kept = sa[windows[sa]]
    flags = np.zeros(len(text), dtype=bool)
    same = np.flatnonzero(shared >= LENGTH)
    flags[kept[same]] = True
    flags[kept[same - 1]] = True
    out = []
    for a, b, n in zip(starts.tolist(), ends.tolist(), counts):
        out.append(flags[a : b - LENGTH + 1] | (n > 1))
    return out


def _found(anchor: int, content: int, flags: np.ndarray) -> list[tuple[int, int, int, int]]:
    return [(anchor, content, int(a), int(b)) for a, b in zip(*_runs(flags))]


_FOUND = "anchor bigint, content bigint, low bigint, high bigint"
_PIECE = "anchor bigint, content bigint, n bigint, shard int, bytes binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)],
        names=[f for f, _ in fields],
    )


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows sorted by (anchor, shard), in lists of whole groups of about ``SHARD_BYTES``."""
    rows, weight = [], 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "shard", "content", "n", "bytes"))):
            if weight > SHARD_BYTES and rows[-1][:2] != row[:2]:
                yield rows
                rows, weight = [], 0
            rows.append(row)
            weight += len(row[4])
    if rows:
        yield rows


def _sorted_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _grouped(batches):
        flags = repeated_windows([r[4] for r in rows], [r[3] for r in rows])
        if out := [x for r, f in zip(rows, flags) for x in _found(r[0], r[2], f)]:
            yield _batch(out, _FOUND)


_SLICE = "bucket bigint, shard int, anchor bigint, hashes binary, others binary, contents binary, places binary"


def _slices(ranges: int):
    """The windows of a shard of a hot anchor: hashes in order, cut into ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            for shard in dict.fromkeys(r[:2] for r in rows):
                own = [r for r in rows if r[:2] == shard]
                one = [window_hashes(np.frombuffer(r[4], np.uint8), 0)[1] for r in own]
                two = [window_hashes(np.frombuffer(r[4], np.uint8), 1)[1] for r in own]
                sizes = [len(x) for x in one]
                contents = np.repeat(np.array([r[2] for r in own], np.int64), sizes)
                places = np.concatenate([np.arange(k) for k in sizes])
                one, two = np.concatenate(one), np.concatenate(two)
                order = np.lexsort((two, one))
                one, two, contents, places = one[order], two[order], contents[order], places[order]
                cuts = np.array([(i << 64) // ranges for i in range(1, ranges)], dtype=np.uint64)
                ends = [0, *np.searchsorted(one, cuts).tolist(), len(one)]
                for i, (a, b) in enumerate(zip(ends, ends[1:])):
                    if b > a:
                        blobs = [x[a:b].tobytes() for x in (one, two, contents, places)]
                        yield _batch([((shard[0] ^ i), shard[1], shard[0], *blobs)], _SLICE)

    return run


def _merged(key, group):
    """One range of one hot anchor: each shard's sorted hashes are searched in those of the
    shards before it, then merged with them."""
    seen = None
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    for row in group.sort_by("shard").to_pylist():
        one, two = (np.frombuffer(row[c], np.uint64) for c in ("hashes", "others"))
        contents, places = (np.frombuffer(row[c], np.int64) for c in ("contents", "places"))
        now = (one, two, contents, places)
        if seen is not None:
            at = np.minimum(np.searchsorted(seen[0], one), len(seen[0]) - 1)
            equal = (seen[0][at] == one) & (seen[1][at] == two)
            hits += [(contents[equal], places[equal]), (seen[2][at[equal]], seen[3][at[equal]])]
            # Copies within a shard are known from its suffix array; here one of each is enough.
            fresh = ~equal & np.append(True, one[1:] != one[:-1])
            spot = np.searchsorted(seen[0], one[fresh])
            seen = tuple(np.insert(s, spot, x[fresh]) for s, x in zip(seen, now))
        else:
            fresh = np.append(True, one[1:] != one[:-1])
            seen = tuple(x[fresh] for x in now)
    contents = np.concatenate([h[0] for h in hits]) if hits else np.zeros(0, np.int64)
    places = np.concatenate([h[1] for h in hits]) if hits else np.zeros(0, np.int64)
    anchor = np.full(len(contents), key[1].as_py(), np.int64)
    return pa.table([anchor, contents, places, places], names=["anchor", "content", "low", "high"])


def _bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in chunks(batch):
            rows = []
            for text, wanted in zip(texts := piece.column("text").to_pylist(), piece.column("wanted").to_pylist()):
                data = text.encode()
                rows += [
                    (w["anchor"], w["content"], w["n"], w["shard"], data[w["low"] : w["high"] + LENGTH])
                    for w in wanted
                ]
            if rows and texts:
                yield _batch(rows, _PIECE)


def covered(docs: DataFrame, most: int = SHARD_CONTENTS) -> DataFrame:
    """doc_id, th (hash of the text), low, high: byte ranges that repeated windows cover."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    every = cut(texts.mapInArrow(_snippets, _SNIPPETS), "snippets")
    own = every.filter("anchor IS NULL").select("doc_id", "th", "low", "high")
    found = every.filter("anchor IS NOT NULL")
    contents = found.groupBy("anchor", "content").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "low", "high")).alias("one")
    )
    anchors = found.groupBy("anchor").agg(F.count("*").alias("places"), F.min("content").alias("c0"), F.max("content").alias("c1"))
    anchors = anchors.filter("places > 1").select("anchor", (F.col("c0") == F.col("c1")).alias("alike"))
    shared = cut(contents.join(anchors, "anchor"), "contents")
    # One content at several places: all of its windows are repeated.
    alike = shared.filter("alike").select("anchor", "content", F.lit(0).cast("long").alias("low"), (F.col("one.high") - F.col("one.low")).alias("high"))
    differ = shared.filter("NOT alike")
    sizes = differ.groupBy("anchor").agg(F.count("*").alias("k"))
    shards = F.ceil(F.col("k") / most)
    dealt = differ.join(sizes, "anchor").select(
        "one.doc_id",
        "one.th",
        F.struct(
            "anchor",
            "content",
            "n",
            "one.low",
            "one.high",
            F.when(F.col("k") > most, F.pmod(F.xxhash64("content"), shards) + 1).otherwise(0).cast("int").alias("shard"),
        ).alias("w"),
    )
    wanted = dealt.groupBy(F.col("doc_id").alias("id"), F.col("th").alias("hash")).agg(F.collect_list("w").alias("wanted"))
    wanted = cut(wanted, "wanted")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("hash"))
    # Rows that are the same twice give their pieces once.
    pieces = texts.join(wanted, same).dropDuplicates(["doc_id", "th"]).select("text", "wanted")
    pieces = cut(pieces.mapInArrow(_bytes_of, _PIECE), "pieces")
    ordered = pieces.repartition(shuffle_count(spark), "anchor", "shard").sortWithinPartitions("anchor", "shard")
    result = cut(ordered.mapInArrow(_sorted_shards, _FOUND), "repeated").union(alike)
    hot = pieces.filter("shard > 0")
    n_hot = hot.count()
    if n_hot:
        ranges = max(1, n_hot * (LENGTH - GRAM + 1) // RANGE)
        ordered = hot.repartition(shuffle_count(spark), "anchor", "shard").sortWithinPartitions("anchor", "shard")
        slices = cut(ordered.mapInArrow(_slices(ranges), _SLICE), "slices")
        result = result.union(slices.groupBy("bucket", "anchor").applyInArrow(_merged, _FOUND))
    marked = result.select("anchor", "content", F.col("low").alias("from"), F.col("high").alias("to"))
    return (
        found.join(marked, ["anchor", "content"])
        .select("doc_id", "th", (F.col("low") + F.col("from")).alias("low"), (F.col("low") + F.col("to") + LENGTH).alias("high"))
        .union(own)
    )


FIELDS = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, spans array<struct<low:bigint,high:bigint>>"


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
    for batch in batches:
        for piece in chunks(batch):
            rows = []
            for text, ranges, rows_n in zip(*(piece.column(c).to_pylist() for c in ("text", "ranges", "rows_n"))):
                data = text.encode()
                if rows_n > 1 and len(data) >= LENGTH:
                    ranges = [{"low": 0, "high": len(data)}]
                spans: list[list[int]] = []
                for r in sorted(ranges or [], key=lambda r: r["low"]):
                    if spans and r["low"] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r["high"])
                    else:
                        spans.append([r["low"], r["high"]])
                kept, at = [], 0
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                removed = sum(b - a for a, b in spans)
                listed = [{"low": a, "high": b} for a, b in spans]
                rows.append((len(data), removed, len(spans), b"".join([*kept, data[at:]]), listed))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    *(pa.array(c, pa.int64()) for c in columns[:3]),
                    pa.array(columns[3], pa.binary()),
                    pa.array(columns[4], kind),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"],
            )


def remove_repeats(docs: DataFrame, most: int = SHARD_CONTENTS) -> DataFrame:
    """Every row with its bytes left, the counts, and the removed ranges."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = covered(docs, most).groupBy("doc_id", "th").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("th")).groupBy("doc_id", "th").agg(F.count("*").alias("rows_n"))
    known = rows.join(ranges, rows["doc_id"].eqNullSafe(ranges["doc_id"]) & (rows["th"] == ranges["th"]), "left").select(
        rows["doc_id"].alias("id"), rows["th"].alias("hash"), "ranges", "rows_n"
    )
    known = cut(known.filter("ranges IS NOT NULL OR rows_n > 1"), "ranges")
    same = docs["doc_id"].eqNullSafe(F.col("id")) & (F.xxhash64(docs["text"]) == F.col("hash"))
    joined = docs.join(known, same, "left").select("doc_id", "text", "ranges", F.coalesce("rows_n", F.lit(1)).alias("rows_n"))
    return joined.mapInArrow(_remove, FIELDS)
