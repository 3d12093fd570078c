"""Nearest stops and stops within a distance against all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from stopclock.functions.geo import EARTH_RADIUS_M
from stopclock.operators import geo_join
from stopclock.operators.events import vehicles_in_box

DDL = "stop_id string, stop_code string, stop_name string, latitude double, longitude double"


def metres(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    d = math.radians(b[1] - a[1])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(d / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(min(1, math.sqrt(h)))


def scenes():
    rnd = random.Random(7)
    spread = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(150)]
    seam = [(rnd.uniform(-20, 20), 180 - rnd.uniform(0, 2)) for _ in range(40)]
    seam += [(rnd.uniform(-20, 20), -180 + rnd.uniform(0, 2)) for _ in range(40)] + [(0.0, 180.0), (0.0, -180.0)]
    pole = [(90 - rnd.uniform(0, 1), rnd.uniform(-180, 180)) for _ in range(80)] + [(90.0, 0.0), (-90.0, 10.0)]
    crowd = [(43.65 + rnd.gauss(0, 1e-5), -79.38 + rnd.gauss(0, 1e-5)) for _ in range(150)]
    far = [(43.9 + rnd.uniform(0, 0.2), -79.9 + rnd.uniform(0, 0.2)) for _ in range(30)]
    return {
        "spread": (spread, spread[:50] + seam[:10] + pole[:10]),
        "seam": (seam, [(0.0, 179.99), (0.0, -179.99), (5.0, 180.0), (3.0, -180.0), (1.0, 0.0)]),
        "pole": (pole, [(89.9, 10.0), (89.9, -170.0), (90.0, 55.0), (-89.0, 0.0), (0.0, 0.0)]),
        "crowd": (crowd + far, crowd[:40] + far[:10] + [(43.65, -79.3), (43.7, -79.38)]),
        "one_place": ([(43.65, -79.38)] * 60 + far, [(43.65, -79.38), (43.66, -79.38), (44.0, -79.8)]),
        "few": ([(1.0, 1.0), (2.0, 2.0)], [(0.0, 0.0), (50.0, 50.0)]),
    }


@pytest.fixture(params=sorted(scenes()))
def scene(request, spark):
    stops, points = scenes()[request.param]
    stop_rows = [(f"s{i:04d}", None, f"S{i}", *p) for i, p in enumerate(stops)]
    stops_df = spark.createDataFrame(stop_rows, DDL)
    points_df = spark.createDataFrame(
        [(i, *p) for i, p in enumerate(points)], "point_id long, latitude double, longitude double"
    )
    return stop_rows, points, stops_df, points_df


def test_nearest_join_is_exact(scene):
    stops, points, stops_df, points_df = scene
    k = 4
    got = {}
    for r in geo_join.nearest_stops_join(points_df, stops_df, k).collect():
        got.setdefault(r.point_id, []).append((r.rank, r.distance_m, r.stop_id))
    for i, p in enumerate(points):
        expected = sorted((metres(p, s[3:]), s[0]) for s in stops)[:k]
        found = [x[1:] for x in sorted(got[i])]
        assert [d for d, _ in found] == pytest.approx([d for d, _ in expected], abs=1e-3)
        if all(abs(a[0] - b[0]) > 1e-3 for a, b in zip(expected, expected[1:])):
            assert [s for _, s in found] == [s for _, s in expected]


@pytest.mark.parametrize("radius", [50.0, 5_000.0, 3_000_000.0])
def test_within_is_exact(scene, radius):
    stops, points, stops_df, points_df = scene
    got = [(r.point_id, r.stop_id) for r in geo_join.stops_within(points_df, stops_df, radius).collect()]
    assert len(got) == len(set(got))
    sure = {(i, s[0]) for i, p in enumerate(points) for s in stops if metres(p, s[3:]) < radius - 0.01}
    maybe = {(i, s[0]) for i, p in enumerate(points) for s in stops if metres(p, s[3:]) < radius + 0.01}
    assert sure <= set(got) <= maybe


def test_nearest_single(spark):
    stops = spark.createDataFrame(
        [("b", None, "B", 43.0, -79.0), ("a", None, "A", 43.0, -79.0), ("c", None, "C", 43.1, -79.0),
         ("x", None, "X", None, None)], DDL,
    )
    rows = geo_join.nearest_stops(stops, 43.0, -79.0, 3).collect()
    assert [r.stop_id for r in rows] == ["a", "b", "c"]
    assert rows[2].distance_m == pytest.approx(11119.5, abs=1)
    (flat, *_), (round_, *_) = (
        geo_join.nearest_stops(stops.filter("stop_id = 'c'"), 43.0, -79.0, 1, ellipsoidal=e).collect()
        for e in (False, True)
    )
    # 0.1 degrees of latitude at 43 north on WGS 84, by the public meridian arc series.
    assert round_.distance_m == pytest.approx(11110.2, abs=1.5)
    assert flat.distance_m != round_.distance_m


def test_argument_checks(spark):
    stops = spark.createDataFrame([("a", None, "A", 43.0, -79.0)] * 30, DDL)
    for args in ((200, 0, 5), (0, 200, 5), (0, 0, 0), (0, 0, 101)):
        with pytest.raises(ValueError):
            geo_join.nearest_stops(stops, *args)
    assert geo_join.nearest_stops(stops, 43, -79, 1000, clamp=True).count() == 25
    assert geo_join.nearest_stops(stops, 43, -79, 0, clamp=True).count() == 1


def test_box_across_the_date_line(spark):
    rows = spark.createDataFrame([(0.0, 179.5), (0.0, -179.5), (0.0, 0.0)], "latitude double, longitude double")
    assert vehicles_in_box(rows, -1, 179, 1, -179).count() == 2
    assert vehicles_in_box(rows, -1, -1, 1, 1).agg(F.sum("longitude")).first()[0] == 0.0


def test_crowded_cells_are_dealt_over_pieces(spark, monkeypatch):
    ddl = "stop_id string, stop_code string, stop_name string, latitude double, longitude double"
    near = [(43.5 + i * 1e-5, -79.5) for i in range(60)]
    stops = spark.createDataFrame([(str(i), None, None, *p) for i, p in enumerate(near)], ddl).coalesce(1)
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(near)], "point_id int, latitude double, longitude double").coalesce(1)
    whole = sorted((r.point_id, r.stop_id) for r in geo_join.stops_within(points, stops, 20).collect())
    monkeypatch.setattr(geo_join, "PIECE_PAIRS", 100)
    monkeypatch.setattr(geo_join, "TASK_PAIRS", 500)
    dealt = geo_join.stops_within(points, stops, 20)
    assert sorted((r.point_id, r.stop_id) for r in dealt.collect()) == whole and len(whole) > 60
    assert dealt.select(F.spark_partition_id()).distinct().count() > 1
