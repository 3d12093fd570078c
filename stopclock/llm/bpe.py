"""Byte-level BPE encoding and decoding.

Pre-tokens are found without a regex: each code point gets a class from a table, each class
is a transition function on eight states, and an associative scan composes the functions so
that all positions learn their state in a few vector steps.  The functions form a small
closed set, so a composition is one table look-up.  Each pre-token then goes through pair
merging once; a bounded cache keeps the ids of the frequent ones.

Results in special cases: a null text counts as empty and has no ids; a null doc_id and
repeated rows are kept as they are, row by row; an empty table gives an empty result; very
long texts are cut for the scan only where the result cannot change (between documents).
Input columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stopclock.llm.common import chunks, texts_of

# Classes of code points after looking one or two to the right.
L, N, P, Q1, Q2, W, SP, WS, END = range(9)
# States: a new token must start; in letters; in numbers; in other marks; after a space
# that joins what follows; in white space; one or two letters of a contraction to come.
NEW, LETTERS, NUMBERS, MARKS, SPACE, WHITE, ONE, TWO = range(8)

#: Ids that are decoded before the bytes go on.
DECODED = 1 << 18
#: Contraction endings of the pattern: after an apostrophe one of these letters, or a pair.
SHORT, LONG = "stmd", ("re", "ve", "ll")


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The state after a code point of the class, and whether a token starts at it."""
    if kind in (L, N):
        own = LETTERS if kind == L else NUMBERS
        if kind == L and state == TWO:
            return ONE, False
        if kind == L and state == ONE:
            return NEW, False
        return own, state not in (own, SPACE)
    if kind in (P, Q1, Q2):
        joins = state in (MARKS, SPACE)
        return (MARKS if joins or kind == P else ONE if kind == Q1 else TWO), not joins
    if kind == W:
        return WHITE, state != WHITE
    return (SPACE if kind == SP else NEW), True


@lru_cache(1)
def _monoid() -> tuple[bytes, tuple[np.uint8, bytes], bytes, bytes]:
    """Byte tables: a class's function id; the composition of two ids (with the number of
    ids); a function's value at the state NEW; and whether a token starts.

    ``starts[state * 9 + kind]`` tells whether a token starts at a code point of the class.
    """
    functions = [tuple(_step(s, k)[0] for s in range(8)) for k in range(9)]
    known = {f: i for i, f in enumerate(dict.fromkeys([tuple(range(8)), *functions]))}
    grown = True
    while grown:
        grown = False
        for f in list(known):
            for g in functions:
                h = tuple(g[f[s]] for s in range(8))
                if h not in known:
                    known[h] = len(known)
                    grown = True
    every = list(known)
    assert len(every) <= 15, "a pair of ids must fit into a byte"
    compose = bytes(known[tuple(g[f[s]] for s in range(8))] for f in every for g in every)
    starts = bytes(_step(s, k)[1] for s in range(8) for k in range(9))
    return (
        bytes(known[f] for f in functions).ljust(256, b"\0"),
        (np.uint8(len(every)), compose.ljust(256, b"\0")),
        bytes(f[NEW] for f in every).ljust(256, b"\0"),
        starts.ljust(256, b"\0"),
    )


@lru_cache(1)
def _classes() -> np.ndarray:
    """L, N, P, SP or WS for every code point, by the Unicode tables of the encoder library
    that the ids must agree with (they differ between Unicode versions)."""
    import tiktoken

    text = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    single = {bytes([i]): i for i in range(256)}
    table = np.full(0x110000, P, dtype=np.uint8)
    for pattern, kind in ((r"\p{L}", L), (r"\p{N}", N), (r"\s", WS)):
        of_kind = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        members = of_kind.decode(of_kind.encode_ordinary(text))
        table[np.frombuffer(members.encode("utf-32-le"), "<u4")] = kind
    table[0x20] = SP
    return table


def _composed(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Ids of the compositions, place by place; one byte each, so one byte table does it."""
    size, table = _monoid()[1]
    return np.frombuffer((first * size + then).tobytes().translate(table), dtype=np.uint8).reshape(then.shape)


def _scan(codes: np.ndarray) -> np.ndarray:
    """Inclusive prefix compositions of function ids: blocks side by side, then the blocks'
    totals by the same scan, then both together."""
    width = 64
    if len(codes) <= width:
        out = codes.copy()
        for i in range(1, len(codes)):
            out[i] = _composed(out[i - 1 : i], codes[i : i + 1])[0]
        return out
    rows = -(-len(codes) // width)
    padded = np.zeros(rows * width, dtype=np.uint8)  # 0 is the identity
    padded[: len(codes)] = codes
    grid = np.ascontiguousarray(padded.reshape(rows, width).T)
    for i in range(1, width):
        grid[i] = _composed(grid[i - 1], grid[i])
    before = np.zeros(rows, dtype=np.uint8)
    before[1:] = _scan(grid[-1])[:-1]
    return np.ascontiguousarray(_composed(before[None, :], grid).T).reshape(-1)[: len(codes)]


def boundaries(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts in one string, each followed by a separator; where each pre-token or
    separator starts in it; and the separators' places among those starts."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))) - 1
    kinds = _classes()[points]
    kinds[ends] = END
    after = np.append(kinds[1:], END)
    white = (kinds == SP) | (kinds == WS)
    inner = white & ((after == SP) | (after == WS) | (after == END))
    quotes = np.flatnonzero((points == 0x27) & (kinds == P))
    kinds[inner] = W
    if len(quotes):
        padded = np.append(points, [0, 0]).astype(np.uint32)
        one, two = padded[quotes + 1], padded[quotes + 2]
        pair = np.zeros(len(quotes), dtype=bool)
        for a, b in LONG:
            pair |= (one == ord(a)) & (two == ord(b))
        kinds[quotes[np.isin(one, [ord(c) for c in SHORT])]] = Q1
        kinds[quotes[pair]] = Q2
    ids, _, from_new, starts = _monoid()
    codes = np.frombuffer(kinds.tobytes().translate(ids), dtype=np.uint8)
    state = np.frombuffer(_scan(codes).tobytes().translate(from_new), dtype=np.uint8)
    pairs = kinds.copy()
    pairs[1:] += state[:-1] * np.uint8(9)
    begin = np.flatnonzero(np.frombuffer(pairs.tobytes().translate(starts), dtype=bool))
    return joined, begin, np.searchsorted(begin, ends)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: join the neighbours of the lowest rank, leftmost first, until
    none is left to join."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > 256:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    none = 1 << 60
    pairs = [ranks.get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs:
        low = min(pairs)
        if low == none:
            break
        i = pairs.index(low)
        parts[i] += parts.pop(i + 1)
        pairs.pop(i)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As ``merge``, with a heap: long runs stay below quadratic time."""
    from heapq import heapify, heappop, heappush

    n = len(piece)
    end, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heappop(heap)
        if not alive[i] or right[i] >= n or end[right[i]] != stop:
            continue
        j = right[i]
        alive[j], end[i], right[i] = False, stop, right[j]
        if right[i] < n:
            left[right[i]] = i
            if (r := ranks.get(piece[i : end[right[i]]])) is not None:
                heappush(heap, (r, i, end[right[i]]))
        if (h := left[i]) >= 0 and (r := ranks.get(piece[h : end[i]])) is not None:
            heappush(heap, (r, h, end[i]))
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


class Cache:
    """Ids of pre-tokens as little-endian 32-bit integers.  Two generations of ``size``
    entries: a full young one becomes the old one, and what is asked for again moves back."""

    def __init__(self, solve: Callable[[list[str]], Iterable[list[int]]], size: int = 200_000):
        self.solve, self.size = solve, size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def look_up(self, tokens: list[str]) -> list[bytes]:
        found = list(map(self.young.get, tokens))
        if None in found:
            missing = list({t for t, v in zip(tokens, found, strict=True) if v is None})
            got = {t: v for t in missing if (v := self.old.get(t)) is not None}
            new = [t for t in missing if t not in got]
            got.update((t, np.array(ids, dtype="<i4").tobytes()) for t, ids in zip(new, self.solve(new), strict=True))
            if len(self.young) + len(got) > self.size:
                self.old, self.young = self.young, {}
            self.young.update(got)
            found = [got[t] if v is None else v for t, v in zip(tokens, found, strict=True)]
        return found


class TokenTable:
    """Ids of pre-tokens for whole arrays of them.

    In front of ``Cache`` stands a direct-mapped table: the bytes of a pre-token of up to 24
    bytes name a slot that holds those bytes and up to six ids.  A slot is compared in full,
    so a hit is exact; every other pre-token goes through the cache and takes over its slot.
    """

    BYTES, IDS = 24, 6

    def __init__(self, cache: Cache, bits: int = 19):
        self.cache, self.bits = cache, bits
        slots = 1 << bits
        self.keys = np.zeros((slots, 3), dtype=np.uint64)
        self.sizes = np.zeros(slots, dtype=np.uint8)
        self.ids = np.zeros((slots, self.IDS), dtype=np.int32)
        self.counts = np.zeros(slots, dtype=np.uint8)
        used = np.arange(self.BYTES) < np.arange(self.BYTES + 1)[:, None]
        self.masks = (used * np.uint8(255)).view(np.uint64)  # of the bytes of a size

    def _slots(self, keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
        h = keys[:, 0] * odd[0] + keys[:, 1] * odd[1] + keys[:, 2] * odd[2] + sizes.astype(np.uint64)
        h ^= h >> np.uint64(29)
        h *= odd[1]
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, joined: str, begin: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each start in ``begin`` has (separators: none)."""
        data = joined.encode()
        places = begin
        if len(data) != len(joined):
            points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
            widths = np.ones(len(points), dtype=np.uint8)
            for least in (0x80, 0x800, 0x10000):
                widths += points >= least
            places = np.concatenate(([0], np.cumsum(widths, dtype=np.int64)))[begin]
        spans = np.diff(places, append=len(data))
        padded = data + bytes(self.BYTES + 8)
        words = np.ndarray(len(data) + self.BYTES, dtype="<u8", buffer=padded, strides=(1,))
        sizes = np.minimum(spans, self.BYTES).astype(np.uint8)
        keys = self.masks[sizes]
        for i in range(3):
            keys[:, i] &= words[places + 8 * i]
        slots = self._slots(keys, sizes)
        hit = (self.sizes[slots] == sizes) & (spans <= self.BYTES)
        known = self.keys[slots]
        for i in range(3):
            hit &= known[:, i] == keys[:, i]
        counts = self.counts[slots].astype(np.int64)
        own = hit.copy()
        own[ends] = False
        slow = ~hit
        slow[ends] = False
        counts[ends] = 0
        slow = np.flatnonzero(slow)
        stop = np.append(begin[1:], len(joined))
        found = self.cache.look_up([joined[a:b] for a, b in zip(begin[slow].tolist(), stop[slow].tolist(), strict=True)])
        counts[slow] = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        out = np.empty(int(counts.sum()), dtype=np.int32)
        steps = np.arange(self.IDS)
        out_of_cache = ~np.repeat(own, counts)
        at, left = (np.cumsum(counts) - counts)[own], counts[own]
        from_table = self.ids[slots[own]]
        for i in steps:
            more = np.flatnonzero(left > i)
            out[at[more] + i] = from_table[more, i]
        flat = np.frombuffer(b"".join(found), dtype="<i4")
        out[out_of_cache] = flat
        lengths = counts[slow]
        from_ = np.cumsum(lengths) - lengths
        fits = np.flatnonzero((lengths <= self.IDS) & (spans[slow] <= self.BYTES))
        at, first = np.unique(slots[slow[fits]], return_index=True)
        fits = fits[first]
        self.keys[at], self.sizes[at], self.counts[at] = keys[slow[fits]], sizes[slow[fits]], lengths[fits]
        used = steps < lengths[fits, None]
        rows = np.zeros((len(at), self.IDS), dtype=np.int32)
        rows[used] = flat[(from_[fits, None] + steps)[used]]
        self.ids[at] = rows
        return out, counts


def encode_texts(texts: list[str], table: TokenTable) -> tuple[pa.ListArray, pa.ListArray]:
    """Ids of each text, and the code point at which each of its pre-tokens starts."""
    joined, begin, ends = boundaries(texts)
    ids, counts = table.look_up(joined, begin, ends)
    ends_of = np.concatenate(([0], np.cumsum(counts)[ends]))
    first = np.concatenate(([0], ends[:-1] + 1))
    pieces = ends - first
    starts = np.delete(begin, ends) - np.repeat(begin[first], pieces)
    return (
        pa.ListArray.from_arrays(pa.array(ends_of, pa.int32()), pa.array(ids)),
        pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(pieces))), pa.int32()), pa.array(starts, pa.int32())
        ),
    )


@lru_cache(4)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(4)
def rank_table(path: str) -> TokenTable:
    ranks = read_ranks(path)
    return TokenTable(Cache(lambda tokens: (merge(t.encode(), ranks) for t in tokens)))


def encode(docs: DataFrame, rank_path: str) -> DataFrame:
    """doc_id, ids, starts of every text of ``docs``.

    ``ids``: token ids by the ranks in ``rank_path``.  ``starts``: the code point offset of
    each pre-token, so that a span of the text can be traced through its ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rank_table(rank_path)
        for batch in batches:
            for piece in chunks(batch):
                ids, starts = encode_texts(texts_of(piece), table)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), ids, starts], names=["doc_id", "ids", "starts"]
                )

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(
        run, "doc_id bigint, ids array<int>, starts array<int>"
    )


def decode(encoded: DataFrame, rank_path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``decoded``: the bytes of each row's ids.  Null ids give
    null; an id outside the vocabulary is an error."""

    fields = {f.name: f for f in encoded.schema}
    out = ", ".join([*(f"`{c}` {fields[c].dataType.simpleString()}" for c in keep), "decoded binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(rank_path)
        for batch in batches:
            ids = batch.column("ids")
            ends, values, known = np.asarray(ids.offsets), ids.values, ids.is_valid().to_pylist()
            start, rows, weight = 0, [], 0
            for i, ok in enumerate(known):
                # One document's ids at a time become Python numbers.
                own = values.slice(ends[i], ends[i + 1] - ends[i]).to_numpy().tolist()
                rows.append(b"".join(map(words.__getitem__, own)) if ok else None)
                weight += len(own)
                if weight >= DECODED or i + 1 == len(known):
                    kept = (batch.column(c).slice(start, len(rows)) for c in keep)
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, pa.binary())], names=[*keep, "decoded"])
                    start, rows, weight = i + 1, [], 0

    return encoded.select(*dict.fromkeys([*keep, "ids"])).mapInArrow(run, out)


@lru_cache(4)
def _words(path: str) -> dict[int, bytes]:
    return {i: b for b, i in read_ranks(path).items()}
