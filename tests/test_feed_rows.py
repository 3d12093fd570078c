"""Feed messages to rows, signatures and binary payloads."""

from datetime import datetime

import pytest

from stopclock import schemas as S
from stopclock.operators.feed_rows import (
    service_alert_rows,
    split_on_key,
    trip_update_rows,
    vehicle_position_rows,
)
from stopclock.operators.signatures import field_paths, field_signature
from stopclock.sources.payloads import decode_feed_payloads, message_class
from tests import feeds


def test_full_vehicle(spark):
    rows = vehicle_position_rows(feeds.polls(spark, feeds.message(feeds.vehicle_full())))
    assert rows.columns == S.VEHICLE_POSITIONS.columns
    (row,) = rows.collect()
    assert (row.vehicle_id, row.trip_id, row.route_id, row.direction_id) == ("1234", "T-001", "504", 0)
    assert row.latitude == pytest.approx(43.6532, abs=1e-5)
    assert row.longitude == pytest.approx(-79.3832, abs=1e-5)
    assert (row.bearing, row.speed_mps, row.current_status) == (90.0, 12.5, 2)
    assert (row.current_stop_sequence, row.stop_id) == (5, "STOP-A")
    assert row.feed_timestamp == datetime(2023, 11, 14, 22, 13, 20)
    assert len(row.raw_payload_hash) == 64
    assert row.odometer_m is None and row.occupancy_status is None


def test_types_match_the_tables(spark):
    polls = feeds.polls(spark, feeds.message(feeds.vehicle_full(), feeds.trip_update(), feeds.alert()))
    for make, table in (
        (vehicle_position_rows, S.VEHICLE_POSITIONS),
        (trip_update_rows, S.TRIP_UPDATES),
        (service_alert_rows, S.SERVICE_ALERTS),
    ):
        got = [(f.name, f.dataType) for f in make(polls).schema]
        assert got == [(f.name, f.dataType) for f in table.schema]
        assert make(polls).count() == 1


def test_vehicle_without_position_gives_no_row(spark):
    ghost = {"id": "g", "vehicle": {"vehicle": {"id": "ghost"}}}
    assert vehicle_position_rows(feeds.polls(spark, feeds.message(ghost))).count() == 0


def test_minimal_vehicle(spark):
    bare = {"id": "v", "vehicle": {"position": {"latitude": 43.0, "longitude": -79.0}}}
    polls = feeds.polls(spark, feeds.message(bare, timestamp=None))
    rows = vehicle_position_rows(polls)
    (row,) = rows.collect()
    assert row.feed_timestamp == row.received_at
    assert row.vehicle_id is None and row.trip_id is None and row.bearing is None
    whole, unkeyed = split_on_key(rows, S.VEHICLE_POSITIONS.key)
    assert (whole.count(), unkeyed.count()) == (0, 1)


def test_trip_update(spark):
    (row,) = trip_update_rows(feeds.polls(spark, feeds.message(feeds.trip_update()))).collect()
    assert row.arrival_time == datetime(2023, 11, 14, 22, 18, 20)
    assert row.arrival_delay_s == 60 and row.stop_sequence == 5
    assert str(row.start_date) == "2026-04-14"
    assert row.departure_time is None


def test_bad_start_date_and_empty_trip_update(spark):
    bad, empty = feeds.trip_update(), feeds.trip_update()
    bad["trip_update"]["trip"]["start_date"] = "20261341"
    empty["trip_update"]["stop_time_update"] = []
    rows = trip_update_rows(feeds.polls(spark, feeds.message(bad, empty))).collect()
    assert [r.start_date for r in rows] == [None]


def test_alert(spark):
    (row,) = service_alert_rows(feeds.polls(spark, feeds.message(feeds.alert()))).collect()
    assert row.header_text == "504 King: detour at Spadina"
    assert (row.cause, row.effect, row.severity_level) == (9, 4, 2)
    assert row.affected_routes == ["504"] and row.affected_stops == [] and row.affected_trips == []
    assert row.active_period_start == datetime(2023, 11, 14, 22, 13, 20)
    assert row.active_period_end == datetime(2023, 11, 15, 1, 0, 0)
    assert row.description_text is None


@pytest.mark.parametrize(
    "translations, expected",
    [
        ([{"text": "Bonjour", "language": "fr"}, {"text": "Hi", "language": "EN-ca"}], "Hi"),
        ([{"text": "Bonjour", "language": "fr"}, {"text": "Hi"}], "Bonjour"),
        ([{"text": "Bonjour", "language": "fr"}, {"text": "", "language": "en"}], ""),
        ([{"text": "plain"}], "plain"),
        ([], None),
    ],
)
def test_alert_language(spark, translations, expected):
    a = feeds.alert()
    a["alert"]["header_text"]["translation"] = translations
    (row,) = service_alert_rows(feeds.polls(spark, feeds.message(a))).collect()
    assert row.header_text == expected


def test_rejected_payloads(spark):
    polls = feeds.polls(
        spark, feeds.message(feeds.vehicle_full()), " <!DOCTYPE html><html>", "{oops", ""
    )
    reasons = [r.reject_reason for r in polls.orderBy("path").collect()]
    assert reasons == [None, "html_page", "not_a_feed", "empty"]


def test_signature_is_stable_and_notices_new_fields(spark):
    from pyspark.sql import functions as F

    more, unknown = feeds.vehicle_full(), feeds.vehicle_full()
    more["vehicle"]["occupancy_status"] = "MANY_SEATS_AVAILABLE"
    unknown["vehicle"]["wheelchair"] = {"accessible": True, "notes": [], "empty": None}
    times = tuple(f"2026-04-14 12:0{i}:00" for i in range(5))
    polls = feeds.polls(
        spark,
        feeds.message(feeds.vehicle_full()),
        feeds.message(feeds.vehicle_full()),
        feeds.message(more),
        feeds.message(unknown),
        feeds.message(),
        times=times,
    ).withColumn("feed_key", F.lit("f"))
    a, b, c, d, e = field_signature(polls).orderBy("received_at").collect()
    assert a.signature_hash == b.signature_hash != c.signature_hash
    assert a.populated_fields == [
        "id", "vehicle", "vehicle.current_status", "vehicle.current_stop_sequence",
        "vehicle.position", "vehicle.position.bearing", "vehicle.position.latitude",
        "vehicle.position.longitude", "vehicle.position.speed", "vehicle.stop_id",
        "vehicle.trip", "vehicle.trip.direction_id", "vehicle.trip.route_id",
        "vehicle.trip.trip_id", "vehicle.vehicle", "vehicle.vehicle.id",
    ]
    assert set(d.populated_fields) - set(a.populated_fields) == {
        "vehicle.wheelchair", "vehicle.wheelchair.accessible"
    }
    assert e.populated_fields == []
    assert e.signature_hash == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


@pytest.mark.parametrize(
    "shape, paths",
    [
        ("VOID", []),
        (None, []),
        ("OBJECT<>", []),
        ("OBJECT<a: BIGINT, b: VOID>", ["a"]),
        ("OBJECT<a: ARRAY<VOID>, b: ARRAY<OBJECT<c: DECIMAL(3,2), d: OBJECT<>>>>", ["b", "b.c", "b.d"]),
        ("OBJECT<`a,b``<c`: STRING>", ["a,b`<c"]),
    ],
)
def test_field_paths(shape, paths):
    assert field_paths(shape) == paths


def test_binary_payloads_give_the_rows_of_their_json(spark):
    feed = message_class()()
    feed.header.gtfs_realtime_version = "2.0"
    feed.header.timestamp = 1_700_000_000
    entity = feed.entity.add(id="v1")
    entity.vehicle.vehicle.id = "1234"
    entity.vehicle.trip.trip_id = "T-001"
    entity.vehicle.trip.direction_id = 0
    entity.vehicle.position.latitude = 43.6532
    entity.vehicle.position.longitude = -79.3832
    entity.vehicle.current_status = 2
    payloads = [(feeds.RECEIVED, feed.SerializeToString()), (feeds.RECEIVED, b"\xff\xff"), (feeds.RECEIVED, b"")]
    raw = spark.createDataFrame(payloads, "received_at string, content binary").selectExpr(
        "cast(received_at as timestamp) as received_at", "content"
    )
    decoded = decode_feed_payloads(raw)
    assert sorted(str(r.reject_reason) for r in decoded.collect()) == ["None", "empty", "not_a_feed"]
    assert {r.reject_reason for r in decoded.collect() if r.decode_error} == {"not_a_feed"}
    (row,) = vehicle_position_rows(decoded.filter("reject_reason is null")).collect()
    assert (row.vehicle_id, row.trip_id, row.direction_id, row.current_status) == ("1234", "T-001", 0, 2)
    assert row.feed_timestamp == datetime(2023, 11, 14, 22, 13, 20)
    assert row.latitude == pytest.approx(43.6532, abs=1e-5) and row.bearing is None
