"""Token ids as ORC files in ascending document order.

Each file holds one range of document ids, so file names, stripes and the ids inside them
ascend together.  Integers are run-length encoded by the format; every stripe has row indexes
and a Bloom filter on ``doc_id``, so that a reader takes whole stripes in parallel and skips
those that cannot hold a document.

Results in special cases: a null text counts as empty and has the end id only; null ids come
first; rows that share a doc_id are ordered by text; an empty table gives an empty folder of
the same schema.  Input columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stopclock.llm.bpe import Cache, TokenTable, encode_texts
from stopclock.llm.common import chunks, cut, in_id_order, shuffle_count, texts_of

#: Pre-tokens that one call of the library encodes, and the table's size (2^20 slots, 52 MB).
LINES, BITS = 128, 20
COLUMNS = "part int, place bigint, doc_id bigint, ids array<int>"


@lru_cache(4)
def _library_table(path: str) -> tuple[TokenTable, re.Pattern | None, dict[str, int]]:
    """The ids of pre-tokens, and the file's added tokens: the pattern that cuts them out of a
    text, longer ones first, and their ids.

    Pre-tokens are independent of each other in this vocabulary's model, so the library
    encodes each frequent one once."""
    # A task has one core: threads of the library would only add to its CPU time.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    added = tokenizer.get_added_tokens_decoder()
    if any(t.single_word or t.lstrip or t.rstrip for t in added.values()):
        raise ValueError(f"{path}: added tokens that look at their neighbours are not supported")
    number = {t.content: i for i, t in added.items() if t.content}
    literal = "|".join(map(re.escape, sorted(number, key=len, reverse=True)))

    line_end = tokenizer.encode("\n", add_special_tokens=False).ids

    def solve(tokens: list[str]) -> Iterator[np.ndarray | list[int]]:
        # Beside a pre-token that is not white space a line end is a pre-token of its own, so
        # one call encodes many, a line each.
        lines = [t for t in tokens if not t.isspace()] if len(line_end) == 1 else []
        of_lines = in_lines(lines)
        for t in tokens:
            yield tokenizer.encode(t, add_special_tokens=False).ids if t.isspace() or not lines else next(of_lines)

    def in_lines(tokens: list[str]) -> Iterator[np.ndarray]:
        for i in range(0, len(tokens), LINES):
            some = tokens[i : i + LINES]
            (encoded,) = tokenizer.encode_batch_fast(["\n".join([*some, ""])], add_special_tokens=False)
            ids = np.array(encoded.ids, dtype=np.int32)
            ends = np.flatnonzero(ids == line_end[0]).tolist()
            if len(ends) != len(some):
                raise ValueError(f"{path}: line ends are not tokens of their own")
            yield from (ids[a:b] for a, b in zip([0, *(e + 1 for e in ends[:-1])], ends, strict=True))

    return TokenTable(Cache(solve), BITS), re.compile(f"({literal})") if number else None, number


def _encode(texts: list[str], path: str) -> pa.ListArray:
    """Ids of each text.  Added tokens are cut out first, as the library does, and the text
    between them is encoded piece by piece."""
    table, added, number = _library_table(path)
    if added is None or not any(c in t for t in texts for c in number):
        return encode_texts(texts, table)[0]
    parts = [added.split(t) for t in texts]  # text and added token in turn
    ids, _ = encode_texts([t for p in parts for t in p[::2]], table)
    ends = np.asarray(ids.offsets)[1:]
    cuts = np.array([len(p) // 2 for p in parts])
    last = np.cumsum(cuts + 1) - 1
    own = np.array([number[t] for p in parts for t in p[1::2]], dtype=np.int32)
    values = np.insert(np.asarray(ids.values), np.delete(ends, last), own)
    offsets = np.concatenate(([0], ends[last] + np.cumsum(cuts)))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def _with_end(ids: pa.ListArray, end_id: int) -> pa.ListArray:
    offsets = np.asarray(ids.offsets)
    values = np.insert(np.asarray(ids.values), offsets[1:], np.int32(end_id))
    return pa.ListArray.from_arrays(pa.array(offsets + np.arange(len(offsets)), pa.int32()), pa.array(values))


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, parts: int | None = None) -> None:
    """Encode every text, append ``end_id`` and write the ids to ``path``."""
    parts = parts or shuffle_count(docs.sparkSession)
    rows, _ = in_id_order(docs, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches:
            for piece in chunks(batch):
                ids = _encode(texts_of(piece), tokenizer_path)
                places = pa.array(range(place, place + piece.num_rows), pa.int64())
                place += piece.num_rows
                yield pa.RecordBatch.from_arrays(
                    [piece.column("part"), places, piece.column("doc_id"), _with_end(ids, end_id)],
                    names=["part", "place", "doc_id", "ids"],
                )

    ordered = rows.repartitionById(parts, "part").sortWithinPartitions("part", "doc_id", "text")
    (
        ordered.mapInArrow(run, COLUMNS)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.create.index", "true")
        .option("compression", "zstd")
        .orc(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """part, place, doc_id, ids as written."""
    return spark.read.schema(COLUMNS).orc(path)


def find(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """The rows of one document; Bloom filters and row indexes skip the other stripes."""
    return read(spark, path).filter(F.col("doc_id") == doc_id)


def index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the files."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            offsets = np.asarray(ids.offsets)
            data = memoryview(np.ascontiguousarray(np.asarray(ids.values), dtype="<u4")).cast("B")
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("part", "place", "doc_id")),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["part", "place", "doc_id", "n_tokens", "ids_crc32"],
            )

    rows = cut(
        read(spark, path).mapInArrow(
            sums, "part int, place bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"
        ),
        "token-index",
    )
    # One row a file; the running sum over them is small whatever the number of documents.
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = totals.select(
        "part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before")
    )
    inside = Window.partitionBy("part").orderBy("place")
    return (
        rows.withColumn("inside", F.sum("n_tokens").over(inside) - F.col("n_tokens"))
        .join(before, "part")
        .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )
