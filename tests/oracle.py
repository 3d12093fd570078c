"""Runs a query and its SQL and reports how they differ."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _kind(t) -> str:
    text = str(t)
    return {"large_string": "string", "string_view": "string"}.get(text, text)


def _rows(table) -> tuple[list[str], list[str], list[tuple]]:
    names = sorted(table.column_names)
    kinds = [_kind(table.schema.field(n).type) for n in names]
    columns = [table.column(n).to_pylist() for n in names]
    rows = list(zip(*columns, strict=True)) if columns else []

    def order(row):
        return tuple((v is None, f"{v:.9e}" if isinstance(v, float) else str(v)) for v in row)

    return names, kinds, sorted(rows, key=order)


def difference(spark_df, con, sql: str, exact: bool = False) -> str | None:
    """None where both give the same rows, else what differs."""
    names, kinds, rows = _rows(spark_df.toArrow())
    o_names, o_kinds, o_rows = _rows(con.execute(sql).to_arrow_table())
    if names != o_names:
        return f"columns {names} / {o_names}"
    if kinds != o_kinds:
        pairs = zip(names, kinds, o_kinds, strict=True)
        return f"types {[(n, a, b) for n, a, b in pairs if a != b]}"
    if len(rows) != len(o_rows):
        return f"{len(rows)} / {len(o_rows)} rows; only one side: {_sample(rows, o_rows)}"
    for a, b in zip(rows, o_rows, strict=True):
        for n, x, y in zip(names, a, b, strict=True):
            if x == y:
                continue
            if not exact and isinstance(x, float) and isinstance(y, float):
                if math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9):
                    continue
            return f"{n}: {x!r} / {y!r} in {a} / {b}"
    return None


def _sample(rows, o_rows):
    a, b = set(map(str, rows)), set(map(str, o_rows))
    return sorted(a - b)[:3], sorted(b - a)[:3]
