"""Keyed writes as plans: what a table holds after a batch has been merged into it.

Each function takes the current rows and a batch and returns rows; writing them is up
to the caller (``stopclock.plans.tables``).  Batches are reduced to one row per key by
aggregates that combine before the shuffle, and the tables are unique on their keys, so
every join here is one to one and no key can be hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopclock.operators.events import latest_per_key


def append_new(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] = (),
) -> DataFrame:
    """Rows of ``batch`` whose key the table does not have yet, one per key.

    ``order`` decides which of several batch rows with one key counts as the first.
    """
    keys = list(keys)
    fresh = latest_per_key(batch, keys, order) if order else batch.dropDuplicates(keys)
    if "dt" in current.columns and "dt" in fresh.columns and "dt" not in keys:
        keys = keys + ["dt"]
    return fresh.join(current.select(*keys), keys, "left_anti")


def upsert_keep_first(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str] = ("first_seen_at",),
    order: Sequence[str] = (),
    newer: str | None = None,
) -> DataFrame:
    """The table after applying the batch row by row in ``order``: a new key is inserted,
    a known one gets every column of the row except those in ``keep``.

    ``order`` may name batch columns that the table does not have.  With ``newer``, a time
    column, a batch row that is older than the table's leaves the table's row as it is, and
    the columns in ``keep`` take the smaller value: late polls do not undo newer ones.
    """
    keys, keep = list(keys), list(keep)
    rest = [c for c in current.columns if c not in keys and c not in keep]
    rank = F.struct(*(order or [*keep, *rest]))
    changes = batch.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), rank).alias("new_rest"),
        F.min_by(F.struct(*keep), rank).alias("new_keep"),
    )
    held = current.select(
        *keys, F.struct(*rest).alias("old_rest"), F.struct(*keep).alias("old_keep")
    )
    rest_now, keep_now = F.coalesce("new_rest", "old_rest"), F.coalesce("old_keep", "new_keep")
    if newer:
        late = F.col(f"old_rest.{newer}") > F.col(f"new_rest.{newer}")
        rest_now = F.when(late, F.col("old_rest")).otherwise(rest_now)
        first = (F.least(f"old_keep.{c}", f"new_keep.{c}").alias(c) for c in keep)
        keep_now = F.struct(*first)
    merged = held.join(changes, keys, "full_outer").select(
        *keys, rest_now.alias("rest"), keep_now.alias("keep")
    )
    columns = {c: F.col(c) for c in keys}
    columns |= {c: F.col(f"rest.{c}") for c in rest}
    columns |= {c: F.col(f"keep.{c}") for c in keep}
    return merged.select(*[columns[c].alias(c) for c in current.columns])


def upsert_signature(current: DataFrame, observed: DataFrame) -> DataFrame:
    """Signature table after new observations: first and last sighting and how many."""
    return (
        current.unionByName(observed)
        .groupBy("feed_key", "signature_hash")
        .agg(
            F.min("populated_fields").alias("populated_fields"),
            F.min("first_seen_at").alias("first_seen_at"),
            F.max("last_seen_at").alias("last_seen_at"),
            F.sum("sample_count").alias("sample_count"),
        )
    )
