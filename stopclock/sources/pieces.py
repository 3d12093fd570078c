"""Poll files too large for one row, cut into messages of a part of their entities.

A file is read as text that ends at closing braces, so its size is not held anywhere: Spark
sorts these texts by their place, and one pass over them hashes the file, spools it to the
worker's disk and finds the commas between entities at which it may be cut.  Every piece is the whole
message but for the entities of other pieces, so whatever reads a message reads a piece.
"""

from __future__ import annotations

import json
import re
import tempfile
from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A file of more bytes is cut.
WHOLE_BYTES = 8 << 20
#: Bytes of entities that a piece has at least, unless it is the last.
PIECE_BYTES = 1 << 20

_END = "}"
_ENTITY = re.compile(rb'(?<!\\)"entity"\s*:\s*\Z')
_QUOTE, _COMMA, _OPEN, _CLOSE, _ESCAPE = b'",[]\\'
_DEPTH = np.zeros(256, np.int8)
_DEPTH[list(b"{[")], _DEPTH[list(b"}]")] = 1, -1
_SPECIAL = np.zeros(256, bool)
_SPECIAL[list(b'{}[]",\\')] = True


class Cutter:
    """Reads one file's bytes in order and then gives its pieces.

    A message without a list ``entity`` at its top, or with something of that name after it,
    is one piece.
    """

    def __init__(self, piece_bytes: int):
        self.piece_bytes = piece_bytes
        self.spool, self.hash = tempfile.TemporaryFile(), sha256()
        self.size, self.depth, self.quoted, self.escaped = 0, 0, 0, False
        self.head = b""
        self.start = self.end = None
        self.cuts: list[int] = []

    def feed(self, data: bytes) -> None:
        if data:
            self.hash.update(data)
            self.spool.write(data)
            if self.end is None:
                self._scan(np.frombuffer(data, np.uint8), data)
            self.size += len(data)

    def _scan(self, b: np.ndarray, data: bytes) -> None:
        at = np.flatnonzero(_SPECIAL[b])
        c = b[at]
        quotes = c == _QUOTE
        if self.escaped or (c == _ESCAPE).any():
            after = [0] if self.escaped else [-1]
            for p in at[c == _ESCAPE].tolist():
                if p != after[-1]:
                    after.append(p + 1)
                else:
                    after.append(-1)
            self.escaped = after[-1] == len(b)
            quotes &= ~np.isin(at, after)
        quoted = (np.cumsum(quotes) + self.quoted) & 1
        plain = quoted == 0
        depth = self.depth + np.cumsum(_DEPTH[c] * plain)
        if self.start is None:
            for i in np.flatnonzero(plain & (c == _OPEN) & (depth == 2)):
                if _ENTITY.search((self.head + data[: at[i]])[-256:]) and (self.head + data).lstrip()[:1] == b"{":
                    self.start = self.last = self.size + int(at[i]) + 1
                    break
            self.head = (self.head[:256] + (self.head[256:] + data)[-256:]) if self.head else data[:256] + data[256:][-256:]
        if self.start is not None:
            here = plain & (at + self.size >= self.start)
            ends = at[here & (c == _CLOSE) & (depth == 1)]
            if ends.size:
                self.end = self.size + int(ends[0])
            commas = at[here & (c == _COMMA) & (depth == 2)] + self.size
            if self.end is not None:
                commas = commas[commas < self.end]
            i = np.searchsorted(commas, self.last + self.piece_bytes)
            while i < commas.size:
                self.cuts.append(int(commas[i]))
                self.last = self.cuts[-1] + 1
                i = np.searchsorted(commas, self.last + self.piece_bytes)
        if at.size:
            self.depth, self.quoted = int(depth[-1]), int(quoted[-1])

    def pieces(self) -> Iterator[tuple[int, int, bytes]]:
        """Number of the piece, how many there are, and the piece."""
        end = self.size if self.end is None else self.end
        tail = self._read(end, self.size)
        if self.start is None or not self.cuts or _has_more(tail):
            yield 0, 1, self._read(0, self.size)
            return
        head, first = self._read(0, self.start), self.start
        stops = [*self.cuts, end]
        for n, stop in enumerate(stops):
            # Nothing beside a comma is not a message, as in the whole file.
            yield n, len(stops), head + (self._read(first, stop).strip() or b",") + tail
            first = stop + 1

    def _read(self, start: int, end: int) -> bytes:
        self.spool.seek(start)
        return self.spool.read(end - start)


def _has_more(tail: bytes) -> bool:
    try:
        return "entity" in json.JSONDecoder().raw_decode('{"":[' + tail.decode())[0]
    except ValueError:
        return False


_CUT_DDL = "file bigint, piece int, pieces int, content binary, payload_hash string"
_CUT = pa.schema(
    [("file", pa.int64()), ("piece", pa.int32()), ("pieces", pa.int32()), ("content", pa.binary()), ("payload_hash", pa.string())]
)


def _cut(batches: Iterator[pa.RecordBatch], piece_bytes: int) -> Iterator[pa.RecordBatch]:
    held, cutter, last, size = None, None, b"", 0

    def done() -> Iterator[pa.RecordBatch]:
        # The text's end mark was put behind the file's last bytes as well.
        cutter.feed(last if cutter.size < size else b"")
        digest = cutter.hash.hexdigest()
        for n, count, content in cutter.pieces():
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip((held, n, count, content, digest), _CUT, strict=True)], schema=_CUT
            )

    for batch in batches:
        files, sizes = batch.column("file").to_numpy(), batch.column("size").to_numpy()
        text = batch.column("text").cast(pa.large_binary())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        data = memoryview(text.buffers()[2])
        edges = [0, *(np.flatnonzero(np.diff(files)) + 1).tolist(), len(files)]
        for i, j in zip(edges, edges[1:]):
            if i == j:
                continue
            if cutter is None or files[i] != held:
                if cutter is not None:
                    yield from done()
                held, size, cutter, last = int(files[i]), int(sizes[i]), Cutter(piece_bytes), b""
            part = bytes(data[offsets[i] : offsets[j]])
            cutter.feed(last + part[:-1])
            last = part[-1:]
    if cutter is not None:
        yield from done()


def scan_pieces(spark: SparkSession, folder: str | list[str], pattern: str) -> DataFrame:
    """Pieces of the files of more than ``WHOLE_BYTES``: path, modificationTime, content,
    payload_hash (that of the whole file), piece, pieces, and length, the whole file's at its
    first piece and 0 at the others."""
    file = F.xxhash64("_metadata.file_path").alias("file")
    large = F.col("_metadata.file_size") > WHOLE_BYTES
    text = (
        spark.read.format("text").option("pathGlobFilter", pattern).option("lineSep", _END).load(folder)
        .filter(large)
        .select(
            file,
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
            F.col("_metadata.file_size").alias("size"),
            F.concat(F.col("value").cast("binary"), F.lit(_END).cast("binary")).alias("text"),
        )
    )
    cut = text.repartition("file").sortWithinPartitions("file", "start", "row").mapInArrow(partial(_cut, piece_bytes=PIECE_BYTES), _CUT_DDL)
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
        .filter(large)
        .select(file, "path", "modificationTime", F.col("length").alias("_bytes"))
    )
    length = F.when(F.col("piece") == 0, F.col("_bytes")).otherwise(F.lit(0)).alias("length")
    return cut.join(files, "file").select(
        "path", "modificationTime", "content", "payload_hash", "piece", "pieces", length
    )
