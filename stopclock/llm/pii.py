"""Personal data: fixed patterns, and terms that give a protected value away.

The values that the patterns find are the protected entities.  Over the whole corpus the
operator counts in how many documents each word stands together with an entity, anywhere in
the text, and in how many documents it stands at all (words inside the found values do not
count).  The share of its documents that have the entity gives P(entity | term); compared
with P(entity) it tells how many of the entity's bits of surprise the term reveals.  A term
that reveals nearly all of them, and does so in several different texts, is generalised
wherever it stands, as the entity could be read from it.

Statistics and marks are joined by shuffles.  Only what can matter is counted: entities of
``SUPPORT`` texts, and words that ``SUPPORT`` of the texts with such an entity share.  Words
are counted by chunks of texts before the shuffle.  What is broadcast is a table of slots of
fixed size that spares most texts a shuffle; the joins behind it are exact.  Within a document a word meets those entities only that are frequent
enough to be given away by it.

Results in special cases: a null text counts as empty and has no spans; repeated rows and
null ids are kept row by row and count as documents, but several equal texts support a term
only once; an empty table gives an empty result; every pattern works in linear time, so very
long texts are scanned whole.  ``find`` reads ``doc_id`` and ``text`` only; ``sanitise``
carries all other columns along, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopclock.llm.common import SLOTS, chunks, cut, split_by, texts_of
from stopclock.llm.spans import Span, joined

# The patterns and limits of the base kinds.
BASE_KINDS = ("email", "ip", "card", "phone")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits that fails at its start fails anywhere in it: no need to try again.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS, IP_MOST = (14, 19), (10, 15), 255

KINDS = (*BASE_KINDS, "term")
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}

#: Different texts that must show a term together with an entity.
SUPPORT = 3
#: Least P(entity | term), and least share of the entity's surprise that the term reveals.
GIVEN, DISCLOSED = 0.8, 0.9
#: Terms are runs of two or more letters or digits: short names and badge numbers as well.
_WORD = re.compile(r"[^\W_]{2,}")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    last = 0
    for m in _AT.finditer(text):
        # The local part is the run of its characters before the sign, after the last match.
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end(), "email"))
            last = m.end()
    for m in _IP.finditer(text):
        if all(len(x) <= 3 and int(x or 0) <= IP_MOST for x in (p.lstrip("0") for p in m[0].split("."))):
            out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and _luhn(digits):
            out.append((*m.span(), "card"))
    for m in _PHONE.finditer(text):
        if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]:
            out.append((*m.span(), "phone"))
    return out


def _free(spans: list[Span], size: int) -> Iterator[tuple[int, int]]:
    """The gaps between spans."""
    at = 0
    for a, b, _ in sorted(spans):
        if a > at:
            yield at, a
        at = max(at, b)
    if at < size:
        yield at, size


def entities(text: str, spans: list[Span]) -> set[str]:
    """The protected values of a text, each with its kind."""
    return {f"{kind}:{text[a:b].lower()}" for a, b, kind in spans}


def terms(text: str, spans: list[Span]) -> set[str]:
    """The words of a text outside its spans."""
    return {w.lower() for a, b in _free(spans, len(text)) for w in _WORD.findall(text, a, b)}


def _map_texts(docs: DataFrame, fields: str, work: Callable[[list[str]], list[tuple]]) -> DataFrame:
    """Rows that ``work`` makes from each chunk of texts."""
    schema = docs.sparkSession.createDataFrame([], fields).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch):
                if rows := work(texts_of(piece)):
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.select("text").mapInArrow(run, schema)


def _key(text: str) -> int:
    """What Spark's xxhash64 gives for the text."""
    n = xxhash.xxh64_intdigest(text.encode(), 42)
    return n - (1 << 64) if n >> 63 else n


def _entity_rows(texts: list[str]) -> list[tuple]:
    found = ((text, base_spans(text)) for text in texts)
    return [(_key(text), e) for text, spans in found if spans for e in entities(text, spans)]


def _term_rows(texts: list[str]) -> list[tuple]:
    return [(_key(text), w) for text in texts for w in terms(text, base_spans(text))]


def _slots(listed: DataFrame):
    """Broadcast table that tells which of ``SLOTS`` slots the terms fall into."""
    used = listed.select(F.xxhash64("term").bitwiseAND(SLOTS - 1).alias("slot")).distinct().toArrow()
    table = np.zeros(SLOTS, dtype=bool)
    table[used.column("slot").to_numpy()] = True
    return listed.sparkSession.sparkContext.broadcast(table)


def _in_slots(words: set[str], table: np.ndarray) -> list[str]:
    return [w for w in words if table[xxhash.xxh64_intdigest(w.encode(), 42) & (SLOTS - 1)]]


def _chunk_counts(texts: list[str]) -> list[tuple]:
    return list(Counter(w for t in texts for w in terms(t, base_spans(t))).items())


def statistics(docs: DataFrame) -> DataFrame:
    """entity, term, both, texts, of_entity, documents: document counts of every pair that
    stands together in ``SUPPORT`` different texts and whose term is not too frequent to
    give the entity away.  ``texts`` counts equal texts once, the others every row."""
    seen = _map_texts(docs, "key bigint, entity string", _entity_rows)
    seen = cut(seen.groupBy("entity", "key").agg(F.count("*").alias("n")), "pii-entities")
    known = seen.groupBy("entity").agg(F.sum("n").alias("of_entity"), F.count("*").alias("texts"))
    known = known.filter(F.col("texts") >= SUPPORT).drop("texts")
    held = cut(seen.join(known, "entity"), "pii-held")
    names = ("entity", "term", "both", "texts", "of_entity", "documents")
    if held.isEmpty():
        none = held.withColumn("term", F.lit("")).withColumn("texts", F.lit(0).cast("long"))
        return none.select("entity", "term", F.col("n").alias("both"), "texts", "of_entity", F.col("n").alias("documents"))
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    maybe, _ = split_by(texts, F.col("key"), held, F.col("key"))
    holders = maybe.join(held.select("key").distinct(), "key", "left_semi")
    words = cut(_map_texts(holders, "key bigint, term string", _term_rows).distinct(), "pii-words")
    # Half a document more than needed, so that rounding drops no term.  A word that alone the
    # texts with entities show too often for the most frequent entity beside it goes at once.
    most = held.groupBy("key").agg(F.max("of_entity").alias("most"))
    shared = words.join(most, "key").groupBy("term").agg(F.count("*").alias("texts"), F.max("most").alias("most"))
    shared = shared.filter((F.col("texts") >= SUPPORT) & (F.col("texts") * GIVEN <= F.col("most") + 0.5))
    shared = cut(shared.select("term"), "pii-shared")
    counted = _map_texts(docs, "term string, n bigint", _chunk_counts)
    documents = cut(counted.groupBy("term").agg(F.sum("n").alias("documents")).join(shared, "term"), "pii-documents")
    likely = F.col("documents") * GIVEN <= F.col("of_entity") + 0.5
    return (
        words.join(documents, "term")
        .join(held, "key")
        .filter(likely)
        .groupBy("entity", "term", "of_entity", "documents")
        .agg(F.sum("n").alias("both"), F.count("*").alias("texts"))
        .filter(F.col("texts") >= SUPPORT)
        .select(*names)
    )


def revealing_terms(docs: DataFrame) -> DataFrame:
    """term of every word that gives some entity away."""
    given = F.col("both") / F.col("documents")
    surprise = -F.log2(F.col("of_entity") / F.lit(max(1, docs.count())))
    found = statistics(docs).filter((given >= GIVEN) & (surprise > 0) & (1 + F.log2(given) / surprise >= DISCLOSED))
    return found.select("term").distinct()


def with_terms(docs: DataFrame) -> DataFrame:
    """row (all columns of ``docs``), known: the revealing terms that its text may hold, null
    if none.

    Equal texts hold equal terms, so the terms are kept by the hash of the text, and only
    texts whose hash may be among them are shuffled.
    """
    revealing = cut(revealing_terms(docs), "pii-terms")
    rows = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
    )
    if revealing.isEmpty():
        return rows.select("row", F.lit(None).cast("array<string>").alias("known"))
    slots = _slots(revealing)

    def work(texts: list[str]) -> list[tuple]:
        return [(_key(t), w) for t in texts for w in _in_slots(terms(t, base_spans(t)), slots.value)]

    marks = _map_texts(docs, "key bigint, term string", work).join(revealing, "term")
    marks = cut(marks.groupBy("key").agg(F.collect_set("term").alias("known")), "pii-marks")
    maybe, others = split_by(rows, F.col("key"), marks, F.col("key"))
    return (
        maybe.join(marks.hint("merge"), "key", "left")
        .select("row", "known")
        .union(others.select("row", F.lit(None).cast("array<string>")))
    )


def term_spans(text: str, base: list[Span], known: set[str]) -> list[Span]:
    out = []
    for a, b in _free(base, len(text)):
        for m in _WORD.finditer(text, a, b):
            if m[0].lower() in known:
                out.append((*m.span(), "term"))
    return out


def _spans_of(texts: list[str], known: list[list[str] | None]) -> Iterator[tuple[list[Span], list[Span]]]:
    for text, listed in zip(texts, known, strict=True):
        base = base_spans(text)
        yield base, term_spans(text, base, set(listed)) if listed else []


def _pieces(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """The rows of ``with_terms`` in pieces of bounded text, each with its known terms."""
    for batch in batches:
        rows, known = batch.column("row").flatten(), batch.column("known")
        for piece in chunks(pa.RecordBatch.from_arrays([*rows, known], names=[*names, " known"])):
            yield piece.select(range(len(names))), piece.column(len(names)).to_pylist()


FIELDS = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_spans string, spans string"


def find(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the base spans and all spans of every text."""
    docs = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, known in _pieces(batches, names):
            rows = []
            for base, added in _spans_of(texts_of(piece), known):
                n = Counter(k for _, _, k in base)
                rows.append((*(n[k] for k in BASE_KINDS), joined(base, KINDS), joined(base + added, KINDS)))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    *(pa.array(c, pa.int64()) for c in columns[:4]),
                    *(pa.array(c, pa.string()) for c in columns[4:]),
                ],
                names=[f.split()[0] for f in FIELDS.split(", ")],
            )

    return with_terms(docs).mapInArrow(run, FIELDS)


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by the label of its kind; of overlapping spans the
    first one names the label and all of them go."""
    out, at = [], 0
    for a, b, kind in sorted(spans):
        if a >= at:
            out += [text[at:a], LABELS[kind]]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced by labels in ``text``, and ``n_chars`` set anew
    where there is such a column.  A null text stays null."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, known in _pieces(batches, names):
            columns = {c: piece.column(c) for c in names}
            texts = columns["text"].to_pylist()
            found = _spans_of([t or "" for t in texts], known)
            clean = [None if t is None else masked(t, b + s) for t, (b, s) in zip(texts, found, strict=True)]
            columns["text"] = pa.array(clean, columns["text"].type)
            if "n_chars" in columns:
                sizes = [None if t is None else len(t) for t in clean]
                columns["n_chars"] = pa.array(sizes, pa.int64()).cast(columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return with_terms(docs).mapInArrow(run, docs.schema)
