"""Which fields a feed fills: the drift signature.

The fixed feed schema would hide a field that is new, which is what the signature is
for, so this works on the JSON itself.  Spark merges the shapes of all entities of a poll
(``schema_of_variant_agg``, an aggregate that combines before its shuffle) into one short
type text; only that text is turned into paths.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopclock.functions.text import sha256

_TOKEN = re.compile(r"`((?:[^`]|``)*)`|([^\s<>:,`(]+(?:\([^)]*\))?)|([<>:,])")


def field_paths(shape: str | None) -> list[str]:
    """Sorted dotted paths of a shape such as ``OBJECT<id: STRING, trip: OBJECT<...>>``.

    A field counts where it holds something: not VOID, and not a list of nothing.
    """
    paths: set[str] = set()
    tokens = [
        (m.group(1).replace("``", "`") if m.group(1) is not None else m.group(2), m.group(3))
        for m in _TOKEN.finditer(shape or "")
    ]
    at = 0

    def walk(prefix: str) -> bool:
        """Reads one type; tells whether it holds anything."""
        nonlocal at
        kind = tokens[at][0]
        at += 1
        opened = at < len(tokens) and tokens[at][1] == "<"
        if kind == "ARRAY" and opened:
            at += 1
            filled = walk(prefix)
            at += 1
            return filled
        if kind == "OBJECT":
            if opened:
                at += 1
                while tokens[at][1] != ">":
                    name = tokens[at][0]
                    at += 2
                    path = f"{prefix}.{name}" if prefix else name
                    if walk(path):
                        paths.add(path)
                    if tokens[at][1] == ",":
                        at += 1
                at += 1
            return True
        return kind != "VOID"

    if tokens:
        walk("")
    return sorted(paths)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _paths(shapes: pd.Series) -> pd.Series:
    return shapes.map(field_paths)


def signature_hash(paths: Column) -> Column:
    return sha256(F.array_join(paths, "\n"))


def field_signature(polls: DataFrame, by: tuple[str, ...] = ("feed_key", "received_at")) -> DataFrame:
    """Signature per feed and poll out of a column ``content`` with the JSON of the message.

    Every poll gets a row, also one without entities (the hash of an empty text).  Paths are
    taken from each distinct shape of an entity and then united: a field that is an object in
    one entity and a text in another keeps its inner paths.
    """
    key = list(by)
    message = F.try_parse_json(F.col("content").cast("string"))
    entities = F.try_variant_get(message, "$.entity", "array<variant>")
    exploded = polls.select(*key, F.explode_outer(entities).alias("entity"))
    shapes = exploded.select(*key, F.schema_of_variant("entity").alias("shape")).distinct()
    each = shapes.select(*key, _paths("shape").alias("paths"))
    united = F.array_sort(F.array_distinct(F.flatten(F.collect_set("paths"))))
    signed = each.groupBy(*key).agg(united.alias("populated_fields"))
    return signed.withColumn("signature_hash", signature_hash(F.col("populated_fields")))


def as_observations(signed: DataFrame) -> DataFrame:
    """Signature rows in the shape of the signature table, one sample each."""
    return signed.select(
        "feed_key",
        "signature_hash",
        "populated_fields",
        F.col("received_at").alias("first_seen_at"),
        F.col("received_at").alias("last_seen_at"),
        F.lit(1).cast("long").alias("sample_count"),
    )
