"""Headways: edges, ties, slices, and one very busy stop."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from stopclock.operators import headway
from stopclock.plans.reports import route_reliability_report

START = datetime(2026, 4, 14, 6, 0, tzinfo=timezone.utc)
DDL = "route_id string, direction_id int, stop_id string, trip_id string, arrival_time timestamp"


def arrivals(spark, *seconds, stop="S", direction=0):
    rows = [
        ("R", direction, stop, f"t{i}", START + timedelta(seconds=s) if s is not None else None)
        for i, s in enumerate(seconds)
    ]
    return spark.createDataFrame(rows, DDL)


def gaps(df, **options):
    return sorted(r.headway_s for r in headway.headways(df, **options).collect())


def test_band_is_open_on_both_ends(spark):
    seconds = [0, 30, 61, 61 + 7199, 61 + 7199 + 7200]
    assert gaps(arrivals(spark, *seconds)) == [31, 7199]


def test_equal_arrivals_and_parts_of_seconds(spark):
    assert gaps(arrivals(spark, 0, 100, 100, 100.9, 200.2)) == [100, 100]
    (row,) = headway.headways(arrivals(spark, 0, 0.7, 50.1)).collect()
    assert row.prev_arrival.microsecond == 700_000 and row.headway_s == 50


def test_null_direction_is_a_group(spark):
    both = arrivals(spark, 0, 100, direction=None).unionByName(arrivals(spark, 40, 240))
    assert gaps(both) == [100, 200]


def test_negative_lower_bound_is_refused(spark):
    with pytest.raises(ValueError):
        headway.headways(arrivals(spark, 0), min_s=-1)


@pytest.mark.parametrize("slice_s", [60, 3600, 86400, headway.SLICE_S])
def test_slices_change_nothing(spark, slice_s):
    rnd = random.Random(3)
    busy = [rnd.randrange(0, 200_000) for _ in range(3000)]
    quiet = [rnd.randrange(0, 200_000) for _ in range(40)]
    both = arrivals(spark, *busy, stop="busy").unionByName(arrivals(spark, *quiet, stop="quiet"))
    expected = []
    for seconds in (busy, quiet):
        seen = sorted(set(seconds))
        expected += [b - a for a, b in zip(seen, seen[1:]) if 30 < b - a < 7200]
    assert gaps(both, slice_s=slice_s) == sorted(expected)
    assert gaps(both.repartition(7, "trip_id"), slice_s=slice_s) == sorted(expected)


def test_collapse(spark):
    rows = [
        ("R", 0, "S", "t", "2026-04-13", "2026-04-13 10:00:00", 100),
        ("R", 0, "S", "t", "2026-04-13", "2026-04-13 10:01:00", 90),
        ("R", 0, "S", "t", "2026-04-14", "2026-04-14 10:00:00", 86_500),
        ("R", 0, "S", "t", "2026-04-14", "2026-04-14 10:01:00", None),
    ]
    df = spark.createDataFrame(
        rows,
        "route_id string, direction_id int, stop_id string, trip_id string, start_date string, "
        "received_at string, at int",
    ).withColumn("arrival_time", F.timestamp_seconds("at"))

    def epochs(**options):
        got = headway.collapse_arrivals(df, **options)
        return sorted(r[0] for r in got.select(F.unix_seconds("arrival_time")).collect())

    assert epochs() == [86_500]
    assert epochs(per_day=True) == [100, 86_500]
    assert epochs(per_day=True, pick="newest") == [90, 86_500]
    with pytest.raises(ValueError):
        headway.collapse_arrivals(df, pick="first")


def test_reliability(spark):
    gap_list = [600, 600, 600, 1200]
    seconds = [0]
    for g in gap_list:
        seconds.append(seconds[-1] + g)
    df = arrivals(spark, *seconds)
    (row,) = headway.route_reliability(headway.headways(df), min_gaps=4).collect()
    assert (row.n_gaps, row.n_stops) == (4, 1)
    assert (row.avg_headway_min, row.stddev_headway_min, row.headway_cov) == (12.5, 5.0, 0.4)
    assert headway.route_reliability(headway.headways(df), min_gaps=5).count() == 0


def test_young_rows_are_left_out(spark):
    df = arrivals(spark, 0, 600, 1200).withColumn("received_at", F.col("arrival_time"))
    edge = START + timedelta(seconds=1260)
    (row,) = route_reliability_report(df, as_of=edge, min_gaps=1).collect()
    assert row.n_gaps == 1
    later = edge + timedelta(seconds=1)
    assert route_reliability_report(df, as_of=later, min_gaps=1).first().n_gaps == 2
