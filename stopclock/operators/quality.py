"""Checks of keys, references and required columns, and a scorecard of rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fk_violations(
    child: DataFrame,
    parent: DataFrame,
    child_cols: Sequence[str],
    parent_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Child keys without a parent, and how many rows have them.

    The child is reduced to its distinct keys first, so a frequent key costs one row in
    the join.  A key with a NULL part refers to nothing and is no violation.
    """
    keys = list(child_cols)
    present = child
    for c in keys:
        present = present.filter(F.col(c).isNotNull())
    counted = present.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    targets = parent.select(
        *[F.col(p).alias(c) for c, p in zip(keys, parent_cols or keys, strict=True)]
    )
    return counted.join(targets, keys, "left_anti")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of NULLs (for text: or empty values) per column that has any; one pass."""
    types = dict(df.dtypes)

    def unset(c: str) -> Column:
        column = F.col(c)
        empty = column == "" if types[c] == "string" else F.lit(False)
        return column.isNull() | empty

    counts = df.agg(*[F.count_if(unset(c)).alias(c) for c in columns])
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_rows")) for c in columns
    ]
    return counts.select(F.inline(F.array(*pairs))).filter(F.col("n_rows") > 0)


def dq_scorecard(
    df: DataFrame,
    rules: Mapping[tuple[str, str], Column],
    unique: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Share of rows that pass each rule.

    ``rules`` maps (dimension, name) to a condition, all evaluated in one pass; a
    condition that is NULL counts as failed.  ``unique`` maps a name to key columns, one
    aggregation each, where the rows beyond the first of a key count as failed.
    """
    names = list(rules)
    passed = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(rules[n]).alias(f"p{i}") for i, n in enumerate(names)],
    )
    lines = [
        F.struct(
            F.lit(dimension).alias("dimension"),
            F.lit(rule).alias("rule"),
            F.col("total").alias("n_rows"),
            F.col(f"p{i}").alias("n_passed"),
        )
        for i, (dimension, rule) in enumerate(names)
    ]
    card = passed.select(F.inline(F.array(*lines)))
    for rule, keys in (unique or {}).items():
        sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
        card = card.unionByName(
            sizes.agg(
                F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
                F.count("*").alias("n_passed"),
            ).select(
                F.lit("uniqueness").alias("dimension"),
                F.lit(rule).alias("rule"),
                "n_rows",
                "n_passed",
            )
        )
    share = F.when(F.col("n_rows") > 0, F.col("n_passed") / F.col("n_rows"))
    return card.withColumn("score", share)
