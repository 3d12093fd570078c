"""Which day partitions have expired."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopclock.functions.times import day
from stopclock.schemas import HOT_DAYS


def partition_name(base: str | Column, d: Column) -> Column:
    prefix = F.lit(base) if isinstance(base, str) else base
    return F.concat(prefix, F.lit("_p"), F.date_format(d, "yyyyMMdd"))


def partition_day(name: Column) -> Column:
    """Day of a name like ``base_p20260601`` or ``dt=2026-06-01``; NULL where it has none."""
    compact = F.regexp_extract(name, r"_p(\d{8})$", 1)
    hive = F.regexp_extract(name, r"^dt=(\d{4}-\d{2}-\d{2})$", 1)
    return F.coalesce(
        F.try_to_date(F.nullif(compact, F.lit("")), "yyyyMMdd"),
        F.try_to_date(F.nullif(hive, F.lit("")), "yyyy-MM-dd"),
    )


def expired_partitions(
    names: DataFrame,
    base: str,
    today: date | str | Column,
    keep_days: int = HOT_DAYS,
    name_col: str = "name",
) -> DataFrame:
    """Partitions of ``base`` older than ``today - keep_days``, attached or not; names
    that carry no valid day are left alone."""
    dated = names.filter(F.regexp_like(F.col(name_col), F.lit(f"^{base}_p[0-9]{{8}}$")))
    dated = dated.withColumn("day", partition_day(F.col(name_col)))
    return dated.filter(F.col("day") < F.date_sub(day(today), keep_days))
