"""Schedule delay in batch and as a stream."""

import json
from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from stopclock.operators import delay
from stopclock.session import scratch_path
from stopclock.streaming.delay_state import REPORT_DDL, DelayState, GroupedDelayState, delay_reports, live_delays

ZONE = "America/Toronto"
# A loop: stop A is served first and last; the last visit is after midnight.
SCHEDULE = [("T", 1, "A", 85_800), ("T", 2, "B", 86_400), ("T", 3, "C", 87_000), ("T", 4, "A", 88_200)]


def at(text):
    return datetime.fromisoformat(f"2026-04-{text}")


# Local 23:50 on the 14th is 03:50 UTC on the 15th.
PREDICTIONS = [
    ("15 03:40:00", 1, "A", "15 03:51:00"),
    ("15 03:50:00", 1, "A", "15 03:52:00"),
    ("15 03:53:00", 1, "A", "15 03:59:00"),  # late: the vehicle stopped at 03:52:30
    ("15 03:50:00", 2, "B", "15 04:03:00"),
    ("15 04:01:00", 2, "B", "15 04:04:00"),
    ("15 04:01:00", 3, "C", "15 04:11:00"),
    ("15 04:01:00", 4, "A", "15 04:29:00"),
    ("14 03:50:00", 1, "A", "14 03:50:30"),  # the same trip a day before
]
SEEN = [
    ("15 03:52:30", 1, 1),
    ("15 03:55:00", 2, 2),
    ("15 04:05:00", 3, 2),
]


@pytest.fixture(scope="module")
def stop_times(spark):
    return spark.createDataFrame(SCHEDULE, "trip_id string, stop_sequence int, stop_id string, arrival_s int")


def updates(spark, start_date=None):
    rows = [(start_date, "T", q, "ttc", "504", stop, at(a), at(r)) for r, q, stop, a in PREDICTIONS]
    return spark.createDataFrame(
        rows,
        "start_date date, trip_id string, stop_sequence int, agency_id string, route_id string, "
        "stop_id string, arrival_time timestamp, received_at timestamp",
    )


def positions(spark):
    rows = [(at(r), "ttc", "T", q, s) for r, q, s in SEEN]
    return spark.createDataFrame(
        rows, "received_at timestamp, agency_id string, trip_id string, current_stop_sequence int, current_status smallint"
    )


def test_service_day_is_inferred(spark, stop_times):
    got = delay.schedule_delay(updates(spark), stop_times, ZONE)
    rows = {(str(r.start_date), r.stop_sequence): r for r in got.collect()}
    assert rows["2026-04-14", 1].delay_s == 540 and rows["2026-04-13", 1].delay_s == 30
    assert rows["2026-04-14", 4].scheduled_at == at("15 04:30:00")
    assert rows["2026-04-14", 4].delay_s == -60 and rows["2026-04-14", 4].day_inferred
    given = delay.schedule_delay(updates(spark, datetime(2026, 4, 14).date()), stop_times, ZONE)
    assert not any(r.day_inferred for r in given.collect())


EXPECTED = {
    ("2026-04-13", 1): ("abandoned", 30),
    ("2026-04-14", 1): ("final", 120),
    ("2026-04-14", 2): ("final", 240),
    ("2026-04-14", 3): ("predicted", 60),
    ("2026-04-14", 4): ("predicted", -60),
}


def test_stop_delays(spark, stop_times):
    def states(as_of):
        got = delay.stop_delays(updates(spark), positions(spark), stop_times, ZONE, as_of)
        return {(str(r.start_date), r.stop_sequence): (r.status, r.delay_s) for r in got.collect()}

    assert states("2026-04-15T04:10:00Z") == EXPECTED
    later = states("2026-04-15T04:36:00Z")
    assert later["2026-04-14", 3] == ("abandoned", 60) and later["2026-04-14", 2] == ("final", 240)
    before = states("2026-04-15T03:51:00Z")
    assert before["2026-04-14", 1] == ("predicted", 120)


def test_finalize_evidence(spark, stop_times):
    visits = delay.schedule_delay(updates(spark), stop_times, ZONE)
    got = delay.finalize_times(visits, delay.sightings(positions(spark), stop_times, ZONE))
    rows = {(str(r.start_date), r.stop_sequence): (r.evidence, r.finalized_at) for r in got.collect()}
    assert rows["2026-04-14", 1] == ("stopped", at("15 03:52:30"))
    assert rows["2026-04-14", 2] == ("passed", at("15 04:05:00"))
    assert rows["2026-04-14", 4] == (None, None)


def stream_states(spark, batches, sweep_minutes=30):
    """Runs the state over reports landed as one file per batch; last state per visit."""
    landing, out, state = (scratch_path(spark, x) for x in ("in", "out", "state"))
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(landing)
    reports = spark.readStream.schema(REPORT_DDL).option("maxFilesPerTrigger", 1).parquet(landing)

    def land(df, n):
        df.withColumn("n", F.lit(n)).write.mode("append").parquet(out)

    query = (
        live_delays(reports, sweep_minutes, "0 seconds")
        .writeStream.foreachBatch(land).outputMode("update")
        .option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = spark.read.parquet(out).orderBy("n").collect()
    return {(str(r.start_date), r.stop_sequence): (r.status, r.delay_s) for r in rows}


def test_stream_equals_batch(spark, stop_times):
    reports = delay_reports(updates(spark), positions(spark), stop_times, ZONE).cache()
    edges = [at("14 00:00:00"), at("15 03:45:00"), at("15 03:52:45"), at("15 04:02:00"), at("15 05:00:00")]
    cuts = [
        reports.filter((F.col("received_at") >= lo) & (F.col("received_at") < hi))
        for lo, hi in zip(edges, edges[1:])
    ]
    expected = {k: v for k, v in EXPECTED.items()}
    assert stream_states(spark, cuts) == expected
    assert stream_states(spark, [reports]) == expected


def test_vanished_vehicle_is_swept(spark, stop_times):
    reports = delay_reports(updates(spark), positions(spark), stop_times, ZONE)
    last = reports.filter("stop_sequence = 4").withColumns(
        {"trip_id": F.lit("other"), "received_at": F.lit(at("15 04:40:00"))}
    )
    got = stream_states(spark, [reports, last])
    assert got["2026-04-14", 3] == ("abandoned", 60)
    assert got["2026-04-14", 2] == ("final", 240)


def test_zone_comes_from_the_agency_table(spark):
    agency = spark.createDataFrame([("ttc", "America/Toronto"), ("x", "UTC")], "agency_id string, agency_timezone string")
    rows = spark.createDataFrame([("ttc",), ("x",), ("none",)], "agency_id string")
    got = delay.with_agency_zone(rows, agency, "z").select("agency_id", "z").collect()
    assert [r.z for r in got] == ["America/Toronto", "UTC", None]


def test_delay_reliability(spark):
    rows = [("504", "2026-04-14", "2026-04-14 16:10:00", s, "final") for s in (-61, -60, 0, 300, 301)]
    rows += [("504", "2026-04-14", "2026-04-14 16:10:00", 9999, "predicted")]
    df = spark.createDataFrame(rows, "route_id string, start_date string, t string, delay_s int, status string")
    df = df.withColumn("scheduled_at", F.col("t").cast("timestamp"))
    (row,) = delay.delay_reliability(df, zone=ZONE).collect()
    assert (row.hour, row.n_visits, row.avg_delay_s, row.median_delay_s, row.on_time_share) == (12, 5, 96.0, 0.0, 0.6)


class CountedState:
    """A handle and its one value, with the number of calls."""

    def __init__(self):
        self.calls, self.value, self.timers = 0, None, set()

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


def test_state_calls_of_a_trip_do_not_grow_with_its_stops():
    def report(kind, us, stop, status=None):
        return Row(
            kind=kind, stop_sequence=stop, route_id="r", stop_id="s", delay_s=60, current_status=status,
            received_us=us, scheduled_us=5, arrival_us=None if status else us,
        )

    state = CountedState()
    trip = DelayState(sweep_minutes=1)
    trip.init(state)
    out = list(trip.handleInputRows(("d", "t"), iter([report("prediction", 10, s) for s in range(40)]), None))
    assert len(out) == 40 and {r.status for r in out} == {"predicted"} and state.calls == 3
    out = list(trip.handleInputRows(("d", "t"), iter([report("position", 20_000, 20, 1)]), None))
    assert [(r.stop_sequence, r.status) for r in out] == [(s, "final") for s in range(21)]
    assert state.calls == 7 and len(state.timers) == 1


def test_state_calls_of_a_group_do_not_grow_with_its_trips():
    def report(trip, us, kind="prediction", status=None):
        packed = dict(
            start_date="2026-04-14", trip_id=trip, kind=kind, stop_sequence=1, route_id="r", stop_id="s", delay_s=60,
            current_status=status, received_us=us, scheduled_us=5, arrival_us=us,
        )
        return Row(report=json.dumps(packed))

    class Clearable(CountedState):
        def clear(self):
            self.calls, self.value = self.calls + 1, None

    class Now:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentWatermarkInMs(self):
            return self.ms

        getExpiryTimeInMs = getCurrentWatermarkInMs

    state = Clearable()
    trips = GroupedDelayState(sweep_minutes=1)
    trips.init(state)
    reports = [report(f"t{n}", n * 1_000_000) for n in range(100)]
    out = list(trips.handleInputRows((0,), iter(reports), None))
    assert sorted(r.trip_id for r in out) == sorted(f"t{n}" for n in range(100))
    assert state.calls == 3 and state.timers == {60_000}
    out = list(trips.handleInputRows((0,), iter([report("t0", 50_000_000, "position", 1)]), None))
    assert [(r.trip_id, r.status) for r in out] == [("t0", "final")] and state.timers == {61_000}
    state.timers.remove(61_000)  # as Spark does with the one that fired
    out = list(trips.handleExpiredTimer((0,), Now(70_000), Now(61_000)))
    # The timer of second 70 has not run out before the watermark has passed it.
    assert sorted(r.trip_id for r in out) == sorted(f"t{n}" for n in range(1, 10))
    assert {r.status for r in out} == {"abandoned"} and state.timers == {70_000}
    state.timers.clear()
    out = list(trips.handleExpiredTimer((0,), Now(10_000_000), Now(70_000)))
    assert len(out) == 90 and state.value is None and not state.timers  # of t0 nothing was open
