"""Headways and route reliability.

A stop may be far busier than the others, so no step hands all rows of a stop to one
task:

* the repeated predictions are collapsed by a plain aggregate, which combines before
  its shuffle;
* arrivals of the same second at a stop are merged the same way (gaps of zero are never
  reported), after which a stop holds at most one row per second;
* the ``lag`` runs inside time slices of a stop, hence over at most one row per second of
  a slice, and years of one stop go to many tasks.  Gaps of ``max_s`` and more are dropped
  anyway, so a slice only has to know the last ``max_s`` seconds before it: rows of that
  time are in both slices, and count in their own only.

Both shuffles after the first one carry collapsed rows only, a small part of the feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopclock.functions.times import utc_day

PLACE = ("route_id", "direction_id", "stop_id")
# A week: at most 604,800 rows per stop, of which about one in eighty is also needed by the
# week after.
SLICE_S = 7 * 86_400


def collapse_arrivals(
    trip_updates: DataFrame, per_day: bool = False, pick: str = "max"
) -> DataFrame:
    """One arrival per route, direction, stop and trip out of the repeated predictions.

    ``pick="max"`` keeps the largest predicted time, ``pick="newest"`` the one received
    last.  ``per_day`` keeps trips that return every day apart by their ``start_date``.
    """
    key = [*PLACE, "trip_id"] + (["start_date"] if per_day else [])
    if pick == "max":
        chosen = F.max("arrival_time")
    elif pick == "newest":
        chosen = F.max_by("arrival_time", F.struct("received_at", "arrival_time"))
    else:
        raise ValueError("pick must be 'max' or 'newest'")
    return (
        trip_updates.filter(F.col("arrival_time").isNotNull())
        .groupBy(*key)
        .agg(chosen.alias("arrival_time"))
    )


def headways(
    arrivals: DataFrame, min_s: int = 30, max_s: int = 7200, slice_s: int = SLICE_S
) -> DataFrame:
    """Seconds since the previous vehicle at the same route, direction and stop, where
    ``min_s < seconds < max_s``.

    Vehicles that share a second are one row, with the first of their times.
    """
    if min_s < 0:
        raise ValueError("min_s must not be negative")
    slice_s = max(slice_s, max_s)
    second = F.col("second")
    own = F.floor(second / slice_s)
    also_next = second >= (own + 1) * slice_s - max_s
    merged = (
        arrivals.select(*PLACE, "arrival_time", F.unix_seconds("arrival_time").alias("second"))
        .withColumn("slice", F.explode(F.when(also_next, F.array(own, own + 1)).otherwise(F.array(own))))
        .groupBy(*PLACE, "slice", "second")
        .agg(
            F.min("arrival_time").alias("arrival_time"),
            F.max("arrival_time").alias("last_arrival"),
        )
    )
    in_slice = Window.partitionBy(*PLACE, "slice").orderBy("second")
    gap = second - F.unix_seconds("prev_arrival")
    return (
        merged.withColumn("prev_arrival", F.lag("last_arrival").over(in_slice))
        .withColumn("headway_s", gap)
        .filter((F.col("slice") == own) & (F.col("headway_s") > min_s) & (F.col("headway_s") < max_s))
        .select(*PLACE, "arrival_time", "prev_arrival", "headway_s")
    )


def _reliability(df: DataFrame, key: list[str], min_gaps: int) -> DataFrame:
    mean, spread = F.avg("headway_s"), F.stddev_samp("headway_s")
    return (
        df.groupBy(*key)
        .agg(
            F.count("*").alias("n_gaps"),
            F.count_distinct("stop_id").alias("n_stops"),
            F.round(mean / 60, 1).alias("avg_headway_min"),
            F.round(spread / 60, 1).alias("stddev_headway_min"),
            F.round(spread / mean, 2).alias("headway_cov"),
        )
        .filter(F.col("n_gaps") >= min_gaps)
    )


def route_reliability(gaps: DataFrame, min_gaps: int = 30) -> DataFrame:
    """Regularity per route and direction; most irregular first, then by route."""
    key = ["route_id", "direction_id"]
    return _reliability(gaps, key, min_gaps).orderBy(
        F.col("headway_cov").desc_nulls_last(), *key
    )


def route_reliability_daily(gaps: DataFrame, min_gaps: int = 1) -> DataFrame:
    """The same per UTC day of the arrival."""
    dated = gaps.withColumn("day", utc_day("arrival_time"))
    return _reliability(dated, ["day", "route_id", "direction_id"], min_gaps)
