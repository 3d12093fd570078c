"""Cases that the driver's tables do not hold."""

from __future__ import annotations

import json
import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from stopclock.functions.times import instant, nearest_service_day, utc_day
from stopclock.operators import delay, events, merges, names
from stopclock.plans import tables
from stopclock.schemas import VEHICLE_POSITIONS
from stopclock.sources import cold, feeds, gtfs_static
from stopclock.streaming.throttle import _allowed, throttle_batch


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def abroad(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/Toronto")
    return other


def positions(session, rows):
    ddl = VEHICLE_POSITIONS.ddl
    names_ = [f.name for f in session.createDataFrame([], ddl).schema]
    full = [tuple(r.get(c) for c in names_) for r in rows]
    return session.createDataFrame(full, ddl)


def row(received, **more):
    base = {"received_at": received, "feed_timestamp": received, "agency_id": "ttc", "vehicle_id": "v"}
    return {**base, "latitude": 43.0, "longitude": -79.0, **more}


def test_text_without_a_zone_is_utc_in_any_session(spark, abroad):
    forms = ("2026-04-14T12:00:00", "2026-04-14 12:00:00Z", "2026-04-14T08:00:00-04:00", datetime(2026, 4, 14, 12))
    for session in (spark, abroad):
        one = session.range(1)
        for form in forms:
            assert one.select(F.unix_seconds(instant(form))).first()[0] == 1776168000
        assert one.select(F.unix_micros(instant("2026-04-14T12:00:00.123457"))).first()[0] == 1776168000123457
        assert one.select(F.unix_seconds(instant("2026-04-14"))).first()[0] == 1776124800
    with pytest.raises(ValueError):
        instant("noon")


def test_an_open_quote_in_a_large_table_is_read_whole(spark, tmp_path):
    head = "trip_id,stop_sequence,stop_id,arrival_time,departure_time"
    (tmp_path / "stop_times.txt").write_text(f'{head}\n"T ""1""",1,S1,08:00:00,08:00:00\nT2,2,"S\n2",08:05:00,08:05:00\n')
    assert gtfs_static.open_quotes(spark, str(tmp_path / "stop_times.txt")) == 2
    rows = gtfs_static.scan_gtfs(spark, str(tmp_path))["stop_times"].collect()
    assert [(r.trip_id, r.stop_id) for r in rows] == [('T "1"', "S1"), ("T2", "S\n2")]
    (tmp_path / "stop_times.txt").write_text(f'{head}\n"T ""1""",1,S1,08:00:00,08:00:00\n')
    assert gtfs_static.open_quotes(spark, str(tmp_path / "stop_times.txt")) == 0


def test_days_are_utc_in_any_session(spark, abroad, tmp_path):
    times = [utc(2026, 4, 14, 1), utc(2026, 4, 14, 23, 59, 59, 999999), utc(2026, 4, 15)]
    for session in (spark, abroad):
        rows = positions(session, [row(t, vehicle_id=str(i)) for i, t in enumerate(times)])
        got = [r[0] for r in rows.select(utc_day("received_at")).collect()]
        assert sorted(got) == [date(2026, 4, 14), date(2026, 4, 14), date(2026, 4, 15)]
        counts = events.daily_counts({"f": rows}, "2026-04-15T12:00:00Z").collect()
        assert [(r.day, r.record_count) for r in counts] == [("2026-04-15", 1), ("2026-04-14", 2)]
        root = str(tmp_path / session.conf.get("spark.sql.session.timeZone").replace("/", "-"))
        tables.append_events(session, root, VEHICLE_POSITIONS, rows)
        stored = tables.read_events(session, root, VEHICLE_POSITIONS)
        assert {r.dt for r in stored.select("dt").distinct().collect()} == {date(2026, 4, 14), date(2026, 4, 15)}
        assert cold.scan_events(stored, "received_at", "2026-04-14T00:30:00Z", "2026-04-14T02:00:00Z").count() == 1
        assert events.recent(stored, "2026-04-14T01:02:00Z").count() == 1


def test_service_day_of_times_far_past_midnight(spark):
    seen = spark.createDataFrame([(utc(2026, 4, 14, 6), 50 * 3600), (utc(2026, 4, 14, 6), 3600)], "t timestamp, s int")
    days = [r[0] for r in seen.select(nearest_service_day(F.col("t"), F.col("s"), F.lit("America/Toronto"))).collect()]
    # 06:00 UTC is 02:00 in Toronto: the fiftieth hour of two days before.
    assert days == [date(2026, 4, 12), date(2026, 4, 14)]


def test_two_runs_in_one_utc_day(spark):
    schedule = spark.createDataFrame([("T", 1, 20 * 3600 + 600), ("T", 2, 20 * 3600 + 900)], "trip_id string, stop_sequence int, arrival_s int")
    ddl = "start_date date, trip_id string, stop_sequence int, agency_id string, route_id string, stop_id string, arrival_time timestamp, received_at timestamp"
    runs = [(None, "T", 1, "ttc", "r", "s", t, t - timedelta(minutes=1)) for t in (utc(2026, 4, 14, 0, 12), utc(2026, 4, 14, 23, 58))]
    updates = spark.createDataFrame(runs, ddl)
    for newest in (True, False):
        got = delay.schedule_delay(updates, schedule, "America/Toronto", newest_only=newest).collect()
        assert sorted((r.start_date, r.delay_s) for r in got) == [(date(2026, 4, 13), 120), (date(2026, 4, 14), -720)]
    seen = [row(t, trip_id="T", current_stop_sequence=1, current_status=2) for t in (utc(2026, 4, 14, 0, 12), utc(2026, 4, 14, 23, 58))]
    visits = delay.sightings(positions(spark, seen), schedule, "America/Toronto").collect()
    assert sorted(r.start_date for r in visits) == [date(2026, 4, 13), date(2026, 4, 14)]
    assert all(r.seen_at == r.last_at for r in visits)


def test_vehicle_count_is_not_cut(spark):
    live = positions(spark, [row(utc(2026, 4, 14, 11, 58), vehicle_id=f"{i:04}", route_id="r") for i in range(600)])
    routes = spark.createDataFrame([("r", "504", "King", 0)], "route_id string, route_short_name string, route_long_name string, route_type int")
    asked = spark.createDataFrame([("504",)], "route_text string")
    got = names.vehicles_on_route(asked, routes, live, "2026-04-14T12:00:00Z").first()
    assert got.vehicle_count == 600 and len(got.vehicles) == 500 and got.truncated
    assert events.latest_positions(live, "2026-04-14T12:00:00Z").count() == 600


def test_late_poll_leaves_a_newer_row(spark):
    ddl = "id string, text string, first_seen_at long, last_seen_at long"
    now = spark.createDataFrame([("a", "new", 90, 100)], ddl)
    late = spark.createDataFrame([("a", "old", 50, 50), ("b", "x", 1, 1)], ddl)
    got = merges.upsert_keep_first(now, late, ["id"], order=["last_seen_at"], newer="last_seen_at").collect()
    assert sorted(tuple(r) for r in got) == [("a", "new", 50, 100), ("b", "x", 1, 1)]


def test_json_without_header_is_no_feed(spark, tmp_path):
    for i, body in enumerate(({"error": "maintenance"}, {}, {"header": {"timestamp": "1700000000"}, "entity": []})):
        (tmp_path / f"{1_700_000_000 + i}.json").write_text(json.dumps(body))
    got = feeds.scan_feed_snapshots(spark, str(tmp_path)).orderBy("received_at").collect()
    assert [r.reject_reason for r in got] == ["not_a_feed", "not_a_feed", None]


def test_quoted_line_breaks_in_static_files(spark, tmp_path):
    (tmp_path / "stops.txt").write_text('stop_id,stop_name,stop_desc\ns1,One,"first\nsecond, line"\ns2,Two,\n')
    (tmp_path / "stop_times.txt").write_text("trip_id,stop_sequence\nt,1\n")
    stops = gtfs_static.scan_gtfs(spark, str(tmp_path))["stops"].orderBy("stop_id").collect()
    assert [(r.stop_id, r.stop_desc) for r in stops] == [("s1", "first\nsecond, line"), ("s2", None)]


def test_throttle_in_any_order(spark):
    times = list(range(30_000))
    start = utc(2026, 4, 14)
    rows = [("hot", start + timedelta(seconds=s)) for s in times] + [("b", start), (None, start)]
    random.Random(1).shuffle(rows)
    got = throttle_batch(spark.createDataFrame(rows, "key string, ts timestamp").repartition(6), "key", "ts", 10, 60)
    counts = {r.key: r.n for r in got.filter("allowed").groupBy("key").agg(F.count("*").alias("n")).collect()}
    assert counts == {"hot": 5000, "b": 1, None: 1}
    assert _allowed([0, 1, 2, 60], None, 0, 2, 60) == ([True, True, False, True], 60, 1)


def test_signature_keeps_inner_fields_of_mixed_types(spark):
    from stopclock.operators.signatures import field_signature

    body = json.dumps({"header": {}, "entity": [{"a": {"b": 1}}, {"a": "x"}]}).encode()
    polls = spark.createDataFrame([("f", utc(2026, 4, 14), body), ("g", utc(2026, 4, 14), b"{}")], "feed_key string, received_at timestamp, content binary")
    got = {r.feed_key: r.populated_fields for r in field_signature(polls).collect()}
    assert got == {"f": ["a", "a.b"], "g": []}


def test_fuzzy_names_of_any_script(spark):
    said = spark.createDataFrame([("\u6771\u4eac\u99c5",), ("Caf\u00e9",)], "query string")
    known = spark.createDataFrame([("\u6771\u4eac\u99c5",), ("caf\u00e9 bar",), ("other",)], "name string")
    got = {(r["query"], r["name"]): round(r["similarity"], 2) for r in names.fuzzy_names(said, known).collect()}
    assert got[("\u6771\u4eac\u99c5", "\u6771\u4eac\u99c5")] == 1 and ("Caf\u00e9", "caf\u00e9 bar") in got and len(got) == 2
