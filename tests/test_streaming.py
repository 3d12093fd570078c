"""Streams give what the batch functions give."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from stopclock import schemas as S
from stopclock.plans import tables
from stopclock.plans.buckets import read_buckets
from stopclock.sources.feeds import scan_feed_snapshots
from stopclock.streaming.freshness import rolling_counts
from stopclock.streaming.ingest import first_per_key, ingest_polls, ingest_stream
from stopclock.streaming.progress import dropped_rows
from stopclock.streaming.throttle import throttle, throttle_batch
from tests import feeds


def land(folder, poll, body):
    folder.mkdir(exist_ok=True)
    (folder / f"feed-{poll}.json").write_text(body if isinstance(body, str) else json.dumps(body))


def ingest(spark, tmp_path, feed, run="one"):
    query = ingest_stream(
        spark, str(tmp_path / "landing"), str(tmp_path / "tables"), feed, str(tmp_path / f"state-{run}")
    )
    query.awaitTermination()


def test_positions(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    nameless = {"id": "n", "vehicle": {"position": {"latitude": 1.0, "longitude": 2.0}}}
    land(landing, 1_700_000_000, feeds.message(feeds.vehicle_full(), nameless))
    land(landing, 1_700_000_060, feeds.message(feeds.vehicle_full()))
    land(landing, 1_700_000_120, "<html>down</html>")
    land(landing, 1_700_000_180, feeds.message())
    for run in ("one", "one", "two"):
        ingest(spark, tmp_path, "vehicle_positions", run)
        rows = tables.read_events(spark, root, S.VEHICLE_POSITIONS).collect()
        assert sorted(str(r.received_at) for r in rows) == ["2023-11-14 22:13:20", "2023-11-14 22:14:20"]
        failures = tables.read_events(spark, root, S.FAILURES).collect()
        assert sorted(r.error_class for r in failures) == ["html_page", "incomplete_key"]
    land(landing, 1_700_000_240, feeds.message(feeds.vehicle_full()))
    ingest(spark, tmp_path, "vehicle_positions", "one")
    assert tables.read_events(spark, root, S.VEHICLE_POSITIONS).count() == 3
    signatures = tables.read_keyed(spark, root, S.SIGNATURES, part="vehicle_positions").collect()
    # An empty poll leaves no signature; the second run landed the same polls again.
    assert sum(s.sample_count for s in signatures) == 3
    runs = tables.read_events(spark, root, S.RUNS).collect()
    assert {r.status for r in runs} == {"success"} and {r.asset_key for r in runs} == {"ttc.vehicle_positions"}
    assert sorted(r.records_written for r in runs) == [0, 1, 2] and all(r.bytes_processed > 0 for r in runs)


def test_two_polls_of_one_second_stay_two(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    other = feeds.vehicle_full()
    other["vehicle"]["vehicle"] = {"id": "another"}
    other["vehicle"]["extra_field"] = 1
    land(landing, "1700000000-a", feeds.message(feeds.vehicle_full()))
    land(landing, "1700000000-b", feeds.message(other))
    land(landing, "1700000000-c", feeds.message(other))  # the same poll under another name
    ingest(spark, tmp_path, "vehicle_positions")
    assert tables.read_events(spark, root, S.VEHICLE_POSITIONS).count() == 2
    assert tables.read_events(spark, root, S.LANDED_POLLS).count() == 2
    signatures = tables.read_keyed(spark, root, S.SIGNATURES, part="vehicle_positions").collect()
    assert sorted(s.sample_count for s in signatures) == [1, 1]


def test_a_failed_run_is_logged_and_landed_again(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    land(landing, 1_700_000_000, feeds.message(feeds.vehicle_full()))
    polls = scan_feed_snapshots(spark, str(landing))
    broken = polls.withColumn("reject_reason", F.raise_error(F.lit("disk full")).cast("string"))
    with pytest.raises(Exception, match="disk full"):
        ingest_polls(spark, broken, root, "vehicle_positions", token="t")
    assert tables.read_events(spark, root, S.LANDED_POLLS).count() == 0
    ingest_polls(spark, polls, root, "vehicle_positions", token="t")
    runs = sorted(tables.read_events(spark, root, S.RUNS).collect(), key=lambda r: r.started_at)
    assert [r.status for r in runs] == ["failure", "success"] and "disk full" in runs[0].error_message
    assert [r.records_written for r in runs] == [None, 1]


def test_trip_updates(spark, tmp_path):
    land(tmp_path / "landing", 1_700_000_000, feeds.message(feeds.trip_update()))
    ingest(spark, tmp_path, "trip_updates")
    (row,) = tables.read_events(spark, str(tmp_path / "tables"), S.TRIP_UPDATES).collect()
    assert (row.trip_id, row.arrival_delay_s, str(row.dt)) == ("T-001", 60, "2023-11-14")


def test_alerts(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    land(landing, 1_700_000_000, feeds.message(feeds.alert("first")))
    ingest(spark, tmp_path, "service_alerts")
    land(landing, 1_700_000_300, feeds.message(feeds.alert("not this"), feeds.alert("second")))
    ingest(spark, tmp_path, "service_alerts")
    land(landing, 1_700_000_600, feeds.message())
    ingest(spark, tmp_path, "service_alerts")
    (row,) = read_buckets(spark, root, S.SERVICE_ALERTS).collect()
    assert (row.header_text, str(row.first_seen_at), str(row.last_seen_at)) == (
        "second", "2023-11-14 22:13:20", "2023-11-14 22:18:20"
    )
    signatures = tables.read_keyed(spark, root, S.SIGNATURES, part="service_alerts").collect()
    # An empty alert poll does leave one: the hash of nothing.
    assert sorted(s.sample_count for s in signatures) == [1, 2]


def source(spark, tmp_path, rows, ddl, files=3):
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, ddl).repartition(files).write.parquet(path)
    return path, spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(path)


def collect(spark, df, mode, name):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name).collect()


def test_repeats_are_dropped(spark, tmp_path):
    start = datetime(2026, 4, 14, tzinfo=timezone.utc)
    rows = [(start + timedelta(seconds=i % 50), f"v{i % 7}") for i in range(700)]
    _, stream = source(spark, tmp_path, rows, "received_at timestamp, vehicle_id string")
    got = collect(spark, first_per_key(stream, ["received_at", "vehicle_id"]), "append", "repeats")
    assert len(got) == len(set(got)) == len({(r[0], r[1]) for r in rows})


def test_rolling_counts(spark, tmp_path):
    rnd = random.Random(5)
    start = datetime(2026, 4, 14, tzinfo=timezone.utc)
    rows = [(start + timedelta(seconds=rnd.randrange(3600)), rnd.choice("ab")) for _ in range(400)]
    path, stream = source(spark, tmp_path, rows, "received_at timestamp, feed_key string", 1)
    got = collect(spark, rolling_counts(stream), "complete", "rolling")
    assert set(got) == set(rolling_counts(spark.read.parquet(path)).collect())
    assert sum(r.record_count for r in got) == 5 * 400


def throttled(spark, tmp_path, batches, limit, window_s, **more):
    """Rows of a stream over the batches, and its checkpoint."""
    ddl, path = "key string, ts timestamp, n int", str(tmp_path / "rows")
    for batch in batches:
        spark.createDataFrame(batch, ddl).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(path)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    query = (
        throttle(stream, "key", "ts", limit, window_s, **more)
        .writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return [r for r in spark.read.parquet(out).collect() if r.key != "mark"], state, query


MARKS = [[("mark", datetime(2030 + y, 1, 1, tzinfo=timezone.utc), 0)] for y in range(2)]


def test_throttle(spark, tmp_path):
    start = datetime(2026, 4, 14, tzinfo=timezone.utc)
    seconds = {"a": [0, 1, 2, 3, 4, 59, 60, 61, 130], "b": [10, 70, 71], "c": [5]}
    rows = [(k, start + timedelta(seconds=s), 0) for k, times in seconds.items() for s in times]
    got, _, _ = throttled(spark, tmp_path, [rows, *MARKS], 3, 60)
    allowed = {k: [r.allowed for r in sorted(got, key=lambda r: r.ts) if r.key == k] for k in seconds}
    assert allowed["a"] == [True] * 3 + [False] * 3 + [True, True, True]
    assert allowed["b"] == [True, True, True] and allowed["c"] == [True]
    assert len(got) == len(rows) and {r.key for r in got} == set(seconds)


def test_a_hot_key_in_any_order_is_as_in_batch(spark, tmp_path):
    rnd = random.Random(11)
    start = datetime(2026, 4, 14, tzinfo=timezone.utc)
    rows = [("hot", start + timedelta(milliseconds=137 * i), i) for i in range(20_000)]
    rows += [(f"k{i % 40}", start + timedelta(milliseconds=911 * i), 100_000 + i) for i in range(2_000)]
    # Shuffled inside ten minutes; micro-batches of about four minutes.
    rows.sort(key=lambda r: r[1].timestamp() + rnd.uniform(0, 600))
    batches = [rows[i : i + 2_000] for i in range(0, len(rows), 2_000)]
    timeless = [("hot", None, -1)]
    got, state, query = throttled(spark, tmp_path, [timeless, *batches, *MARKS], 7, 30, lateness="11 minutes", slice_s=60)
    at_rest = spark.createDataFrame(rows + timeless, "key string, ts timestamp, n int")
    want = throttle_batch(at_rest, "key", "ts", 7, 30).collect()
    assert sorted((r.n, r.allowed) for r in got) == sorted((r.n, r.allowed) for r in want)
    assert dropped_rows(query) == 0
    # Nothing is kept of the keys whose windows are over: only the marks are not done with.
    for name in ("window", "held"):
        reader = spark.read.format("statestore").option("path", state).option("stateVarName", name)
        assert [r.key.key for r in reader.load().select("key").collect()] == ["mark"]


def test_a_quiet_key_is_held_in_one_piece_whatever_the_slices(spark, tmp_path):
    start = datetime(2026, 4, 14, tzinfo=timezone.utc)
    rows = [("a", start + timedelta(seconds=10 * s), s) for s in range(50)]
    got, state, _ = throttled(spark, tmp_path, [rows], 3, 60, lateness="1 hour", slice_s=1)
    assert got == []
    held = spark.read.format("statestore").option("path", state).option("stateVarName", "held").load()
    assert held.count() == 1  # one state call and one timer, not one for each slice


def test_a_busy_key_is_cut_by_slices_and_counted_once(spark, tmp_path):
    start = datetime(2026, 4, 14, tzinfo=timezone.utc)
    rows = [("hot", start + timedelta(milliseconds=100 * (i * 7919 % 9000)), i) for i in range(9000)]
    got, _, _ = throttled(spark, tmp_path, [rows, *MARKS], 5, 20, slice_s=60)
    at_rest = spark.createDataFrame(rows, "key string, ts timestamp, n int")
    want = throttle_batch(at_rest, "key", "ts", 5, 20).collect()
    assert sorted((r.n, r.allowed) for r in got) == sorted((r.n, r.allowed) for r in want)


def test_dropped_rows_are_counted(spark, tmp_path):
    start = datetime(2026, 4, 14, tzinfo=timezone.utc)
    late = [("a", start - timedelta(hours=1), 1)]
    got, _, query = throttled(spark, tmp_path, [[("a", start, 0)], MARKS[0], late, MARKS[1]], 3, 60)
    assert [r.n for r in got] == [0] and dropped_rows(query) == 1


def test_sessions_run_in_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.range(1).select(F.current_timezone()).first()[0] == "UTC"
