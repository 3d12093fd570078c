"""Stored tables: appends, snapshots, archive, retention, relational reads."""

import os
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from stopclock import schemas as S
from stopclock import storage
from stopclock.operators.feed_rows import service_alert_rows, vehicle_position_rows
from stopclock.operators.freshness import freshness_trend, latest_freshness
from stopclock.operators.merges import upsert_signature
from stopclock.plans import export, snapshot, tables
from stopclock.plans.buckets import merge_buckets
from stopclock.plans.reports import record_freshness, stored_freshness
from stopclock.sources import relational
from stopclock.sources.cold import scan_cold, scan_events
from stopclock.sources.gtfs_static import scan_gtfs
from tests import feeds


def positions(spark, *times, vehicle="v1"):
    rows = vehicle_position_rows(feeds.polls(spark, feeds.message(feeds.vehicle_full())))
    stamps = spark.createDataFrame([(t,) for t in times], "t string")
    return rows.drop("received_at").crossJoin(stamps).select(
        F.col("t").cast("timestamp").alias("received_at"),
        *[F.lit(vehicle).alias(c) if c == "vehicle_id" else c for c in S.VEHICLE_POSITIONS.columns if c != "received_at"],
    )


def test_append_twice_is_append_once(spark, tmp_path):
    root = str(tmp_path)
    batch = positions(spark, "2026-04-13 23:59:59.999999", "2026-04-14 00:00:00", "2026-04-14 00:00:00")
    unkeyed = positions(spark, "2026-04-14 01:00:00").withColumn("vehicle_id", F.lit(None).cast("string"))
    for _ in range(2):
        left = tables.append_events(spark, root, S.VEHICLE_POSITIONS, batch.unionByName(unkeyed))
        assert left.count() == 1
        stored = tables.read_events(spark, root, S.VEHICLE_POSITIONS)
        assert sorted(str(r.dt) for r in stored.collect()) == ["2026-04-13", "2026-04-14"]


def test_day_bounds_reach_the_partitions(spark, tmp_path):
    root = str(tmp_path)
    batch = positions(spark, "2026-04-12 10:00:00", "2026-04-13 10:00:00", "2026-04-14 10:00:00")
    tables.append_events(spark, root, S.VEHICLE_POSITIONS, batch)
    stored = tables.read_events(spark, root, S.VEHICLE_POSITIONS)
    one = scan_events(stored, "received_at", "2026-04-13T00:00:00Z", "2026-04-13T12:00:00Z")
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_merge_counts_a_batch_once(spark, tmp_path):
    root = str(tmp_path)
    seen = spark.createDataFrame(
        [("f", "h", ["id"], datetime(2026, 4, 14), datetime(2026, 4, 14), 1)], S.SIGNATURES.ddl
    )
    merge = lambda token: tables.merge_keyed(
        spark, root, S.SIGNATURES, seen, upsert_signature, token=token
    )
    assert [merge("q.0"), merge("q.0"), merge("q.1"), merge(None), merge(None)] == [True, False, True, True, True]
    assert tables.read_keyed(spark, root, S.SIGNATURES).first().sample_count == 4
    assert len(storage.folders(spark, f"{root}/feed_field_signatures")) == 3


def test_export_and_verify(spark, tmp_path):
    root = str(tmp_path)
    day = date(2026, 4, 14)
    rows = positions(spark, "2026-04-13 23:59:59.999999", "2026-04-14 00:00:00", "2026-04-14 23:59:59.999999", "2026-04-15 00:00:00")
    assert export.export_day(rows, None, "vehicle_positions", day)["status"] == "skipped_no_target"
    assert export.export_day(rows.limit(0), root, "vehicle_positions", day)["status"] == "skipped_no_data"
    export.export_day(rows, root, "vehicle_positions", date(2026, 4, 13))
    for _ in range(2):
        done = export.export_day(rows, root, "vehicle_positions", day)
        assert (done["status"], done["rows"]) == ("ok", 2) and done["bytes"] > 0
    assert scan_cold(spark, root, "vehicle_positions").count() == 3
    assert scan_cold(spark, root, "vehicle_positions", day, day).count() == 2
    assert all(r.passed for r in export.verify_export(spark, root, "vehicle_positions", day, 2).collect())
    wrong = export.verify_export(spark, root, "vehicle_positions", day, 3).filter("not passed").collect()
    assert [r.check for r in wrong] == ["rows"]


def test_drop_days(spark, tmp_path):
    root = str(tmp_path)
    times = [f"2026-04-{d:02d} 10:00:00" for d in range(8, 15)]
    tables.append_events(spark, root, S.VEHICLE_POSITIONS, positions(spark, *times))
    gone = export.drop_days(spark, root, "vehicle_positions", date(2026, 4, 14))
    assert gone == ["vehicle_positions_p20260408", "vehicle_positions_p20260409", "vehicle_positions_p20260410"]
    assert tables.read_events(spark, root, S.VEHICLE_POSITIONS).count() == 4
    assert export.drop_days(spark, root, "vehicle_positions", date(2026, 4, 14)) == []


def test_stored_freshness_falls_back_to_older_days(spark, tmp_path):
    root = str(tmp_path)
    tables.append_events(spark, root, S.VEHICLE_POSITIONS, positions(spark, "2026-04-10 10:00:00"))
    other = positions(spark, "2026-04-14 11:59:00").withColumn("agency_id", F.lit("other"))
    tables.append_events(spark, root, S.VEHICLE_POSITIONS, other)
    noon = datetime(2026, 4, 14, 12, tzinfo=timezone.utc)
    row = stored_freshness(spark, root, S.VEHICLE_POSITIONS, "f", noon).first()
    assert (row.last_record_at, row.status) == (datetime(2026, 4, 10, 10), "down")
    row = stored_freshness(spark, root, S.VEHICLE_POSITIONS, "f", noon, agency_id="other").first()
    assert (row.lag_seconds, row.status) == (60, "healthy")


def test_freshness_history(spark, tmp_path):
    root = str(tmp_path)
    tables.append_events(spark, root, S.VEHICLE_POSITIONS, positions(spark, "2026-04-14 11:59:30"))
    alert = service_alert_rows(feeds.polls(spark, feeds.message(feeds.alert()), times=("2026-04-14 11:50:00",)))
    merge_buckets(spark, root, S.SERVICE_ALERTS, alert, lambda _, batch: batch)
    noon = datetime(2026, 4, 14, 12, tzinfo=timezone.utc)
    for minute in (0, 20, 20):
        record_freshness(spark, root, noon + timedelta(minutes=minute))
    history = tables.read_events(spark, root, S.FRESHNESS)
    assert history.count() == 6
    newest = {r.feed_key: (r.lag_seconds, r.status) for r in latest_freshness(history).collect()}
    assert newest == {
        "ttc.vehicle_positions": (1230, "down"),
        "ttc.trip_updates": (None, "down"),
        "ttc.service_alerts": (1800, "lagging"),
    }
    trend = freshness_trend(history, "ttc.vehicle_positions", noon + timedelta(hours=1)).collect()
    assert [r.status for r in trend] == ["down", "healthy"]


# --- static archive ---------------------------------------------------------------------

FILES = {
    "agency": "agency_id,agency_name,agency_timezone\n,Transit,America/Toronto\n",
    "routes": "﻿route_id,route_short_name,route_long_name,route_type\n504,504,\"King, Downtown\", 0 \n",
    "stops": "stop_id,stop_name,stop_lat,stop_lon,location_type\nA, First ,43.65,-79.38,\nB,Second,43.66,-79.39,1\n",
    "trips": "route_id,service_id,trip_id,direction_id\n504,wk,T1,\n",
    "stop_times": "﻿trip_id,arrival_time,departure_time,stop_id,stop_sequence\nT1, 25:30:00,25:31:00,A, 1\nT1,,,B,2\n",
    "calendar": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\nwk,1,1,1,1,1,0,0,20260401,20261231\n",
}


def archive(tmp_path, **changes):
    folder = tmp_path / "gtfs"
    folder.mkdir(exist_ok=True)
    for name, body in {**FILES, **changes}.items():
        path = folder / f"{name}.txt"
        if body is None:
            path.unlink(missing_ok=True)
        else:
            path.write_text(body, encoding="utf-8")
    return str(folder)


def test_static_load(spark, tmp_path):
    root = str(tmp_path / "static")
    counts = snapshot.load_static(spark, archive(tmp_path), root, date(2026, 4, 14))
    assert counts == {"agency": 1, "routes": 1, "stops": 2, "trips": 1, "stop_times": 2, "calendar": 1, "calendar_dates": 0}
    now = snapshot.read_snapshot(spark, root)
    (route,) = now["routes"].collect()
    assert (route.route_id, route.agency_id, route.route_long_name, route.route_type) == ("504", "ttc", "King, Downtown", 0)
    assert now["agency"].first().agency_id == "ttc"
    first, second = now["stop_times"].orderBy("stop_sequence").collect()
    assert (first.arrival_time, first.arrival_s) == (timedelta(hours=25, minutes=30), 91_800)
    assert (second.arrival_time, second.stop_id) == (None, "B")
    stop = now["stops"].orderBy("stop_id").first()
    assert (stop.stop_name, stop.location_type, str(stop.snapshot_date)) == ("First", None, "2026-04-14")


@pytest.mark.parametrize(
    "change, message",
    [
        ({"trips": "route_id,service_id,trip_id\n999,wk,T1\n"}, "trips reference route_id"),
        ({"routes": "route_id,route_type\n504,tram\n"}, "routes.route_type: 1 bad"),
        ({"stops": "stop_id,stop_name,stop_lat,stop_lon\nA,First,43.65,\nB,B,1,1\n"}, "stops not_null longitude"),
        ({"stop_times": "trip_id,stop_id,stop_sequence\nT1,A,1\nT1,B,1\n"}, "stop_times unique_key"),
    ],
)
def test_bad_snapshot_keeps_the_old_one(spark, tmp_path, change, message):
    root = str(tmp_path / "static")
    snapshot.load_static(spark, archive(tmp_path), root, date(2026, 4, 13))
    with pytest.raises(snapshot.SnapshotRefused, match=message):
        snapshot.load_static(spark, archive(tmp_path, **change), root, date(2026, 4, 14))
    assert str(snapshot.read_snapshot(spark, root)["trips"].first().snapshot_date) == "2026-04-13"
    if "reference" in message:
        snapshot.load_static(spark, archive(tmp_path, **change), root, date(2026, 4, 14), strict=False)
        assert snapshot.read_snapshot(spark, root)["trips"].first().route_id == "999"


def test_missing_files(spark, tmp_path):
    folder = archive(tmp_path, calendar=None)
    assert scan_gtfs(spark, folder)["calendar"].count() == 0
    assert "shapes" in scan_gtfs(spark, folder, with_shapes=True)
    os.remove(f"{folder}/stop_times.txt")
    with pytest.raises(FileNotFoundError):
        scan_gtfs(spark, folder)


def test_relational_queries():
    before = datetime(2026, 4, 14, 8, 0, tzinfo=timezone(timedelta(hours=-4)))
    assert relational.bounds_query("t", "received_at", before) == (
        "SELECT min(received_at) AS lo, max(received_at) AS hi FROM t "
        "WHERE received_at < TIMESTAMP WITH TIME ZONE '2026-04-14 12:00:00.000000+00:00'"
    )
    assert relational.frozen_query("t", "r", before).startswith("(SELECT * FROM t WHERE r < TIMESTAMP WITH TIME ZONE '2026-04-14 12")
