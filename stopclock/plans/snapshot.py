"""Loading the static schedule as one snapshot."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stopclock import storage
from stopclock.operators.quality import fk_violations, key_violations, null_violations
from stopclock.operators.static_tables import TYPERS, conversion_faults
from stopclock.schemas import STATIC_REFERENCES, STATIC_TABLES
from stopclock.sources.gtfs_static import scan_gtfs

VIOLATION_DDL = "table_name string, rule string, detail string, n_rows bigint"


class SnapshotRefused(ValueError):
    """The new snapshot breaks its rules; the current one stays."""


def violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Broken keys, missing values and dangling references over all tables: one row per
    rule and column, with the number of rows concerned."""
    parts = []
    for name, df in tables.items():
        table = STATIC_TABLES[name]
        parts.append(
            null_violations(df, table.must_be_set).select(
                F.lit(name).alias("table_name"),
                F.lit("not_null").alias("rule"),
                F.col("column_name").alias("detail"),
                "n_rows",
            )
        )
        parts.append(_total(key_violations(df, table.key), name, "unique_key", table.key))
    for child, child_cols, parent, parent_cols in STATIC_REFERENCES:
        if child in tables and parent in tables:
            dangling = fk_violations(tables[child], tables[parent], child_cols, parent_cols)
            parts.append(_total(dangling, child, "reference", child_cols))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _total(df: DataFrame, table: str, rule: str, columns) -> DataFrame:
    return (
        df.agg(F.sum("n_rows").cast("long").alias("n_rows"))
        .filter(F.col("n_rows") > 0)
        .select(
            F.lit(table).alias("table_name"),
            F.lit(rule).alias("rule"),
            F.lit(",".join(columns)).alias("detail"),
            "n_rows",
        )
    )


def read_snapshot(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of the current snapshot; all from one version."""
    version = storage.current_version(spark, root)
    if version is None:
        return {n: spark.createDataFrame([], t.ddl) for n, t in STATIC_TABLES.items()}
    return {
        name: spark.read.schema(STATIC_TABLES[name].ddl).parquet(f"{version}/{name}")
        for name in storage.folders(spark, version)
    }


def replace_snapshot(
    spark: SparkSession, tables: Mapping[str, DataFrame], root: str, strict: bool = True
) -> dict[str, int]:
    """Write all tables as a new version, check it, make it current; returns row counts.

    The checks read the written version.  With ``strict`` a violation raises
    ``SnapshotRefused`` and readers go on with the old snapshot.
    """
    version = storage.new_version(root)
    counts: dict[str, int] = {}
    for name, df in tables.items():
        seen = Observation()
        (
            df.select(*STATIC_TABLES[name].columns)
            .observe(seen, F.count("*").alias("rows"))
            .write.option("compression", "zstd")
            .parquet(f"{version}/{name}")
        )
        counts[name] = seen.get["rows"]
    if strict:
        written = {
            name: spark.read.schema(STATIC_TABLES[name].ddl).parquet(f"{version}/{name}")
            for name in tables
        }
        found = violations(written).collect()  # one row per broken rule
        if found:
            storage.delete_folder(spark, version)
            raise SnapshotRefused("; ".join(f"{r.table_name} {r.rule} {r.detail}: {r.n_rows}" for r in found))
    storage.point_to(spark, root, version)
    return counts


def load_static(
    spark: SparkSession,
    folder: str,
    root: str,
    snapshot_date: date,
    with_shapes: bool = False,
    strict: bool = True,
) -> dict[str, int]:
    """Read an unpacked archive, type it and make it the current snapshot."""
    raw = scan_gtfs(spark, folder, with_shapes)
    if strict:
        faults = None
        for name, df in raw.items():
            part = conversion_faults(name, df)
            faults = part if faults is None else faults.unionByName(part)
        bad = faults.collect()  # one row per column at most
        if bad:
            raise SnapshotRefused(
                "; ".join(f"{r.table_name}.{r.column_name}: {r.n_faults} bad values" for r in bad)
            )
    typed = {name: TYPERS[name](df, snapshot_date) for name, df in raw.items()}
    return replace_snapshot(spark, typed, root, strict)
