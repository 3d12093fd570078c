"""Which services run on which day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopclock.functions.times import day
from stopclock.schemas import WEEKDAYS

ADDED, REMOVED = 1, 2


def active_services(
    calendar: DataFrame,
    calendar_dates: DataFrame,
    day_from: Column | date | str,
    day_to: Column | date | str,
) -> DataFrame:
    """(service_id, service_date) for every day in the range: the weekly pattern within
    its validity, plus added and minus removed days."""
    lo, hi = day(day_from), day(day_to)
    start, end = F.greatest("start_date", lo), F.least("end_date", hi)
    pattern = F.array(*[F.col(d) for d in WEEKDAYS])
    regular = (
        calendar.filter(start <= end)
        .select("service_id", pattern.alias("runs"), F.explode(F.sequence(start, end)).alias("service_date"))
        .filter(F.get("runs", F.weekday("service_date")))
        .select("service_id", "service_date")
    )
    exceptions = calendar_dates.filter(F.col("exception_date").between(lo, hi)).select(
        "service_id", F.col("exception_date").alias("service_date"), "exception_type"
    )
    removed = exceptions.filter(F.col("exception_type") == REMOVED)
    added = exceptions.filter(F.col("exception_type") == ADDED)
    key = ["service_id", "service_date"]
    return (
        regular.join(removed.select(*key), key, "left_anti")
        .unionByName(added.select(*key))
        .distinct()
    )
