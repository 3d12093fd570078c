"""What the plans must and must not contain."""

import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from checks import views as V
from checks.registry import QUERIES
from stopclock import schemas as S
from stopclock.operators import events, headway, merges
from stopclock.plans import tables
from stopclock.plans.reports import stored_freshness

# Set-up jobs aside, these need a process outside the JVM: the shape text of a poll, and
# the payload codec.
WITH_PYTHON = {"field_signature", "decode_feed_payloads"}
# A left anti join against the first row of a table, to tell whether it is empty.
WITH_NESTED_LOOP = {"agencies"}
JOBS = {
    "append_events", "export_days", "verify_export", "drop_days", "stored_freshness", "merge_keyed",
    "load_static", "stream_without_repeats", "stream_rolling_counts", "stream_live_delays",
    "stream_throttle", "scan_feed_snapshots", "ingest_positions", "ingest_trip_updates", "ingest_alerts",
    "ingest_signatures", "recent_runs_stored", "record_freshness", "merge_keyed_buckets", "stored_delays",
    "delay_reliability_stored", "export_summary", "load_summary", "stream_late_rows",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - JOBS))
def test_no_pairing_and_no_row_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text
    assert ("NestedLoop" in text) == (name in WITH_NESTED_LOOP)
    assert "BatchEvalPython" not in text
    assert ("ArrowEvalPython" in text) == (name in WITH_PYTHON)


def test_latest_row_is_cut_before_the_shuffle(spark, small):
    vp = V.vehicle_positions(spark, small)
    text = plan(events.latest_per_key(vp, ["vehicle_id"], [F.col("received_at").desc()]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_headways_scan_once_and_shuffle_three_times(spark, small):
    text = plan(headway.headways(headway.collapse_arrivals(V.trip_updates(spark, small))))
    assert text.count("FileScan") == 1
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 3
    scanned = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "value" not in scanned and "props" not in scanned


def test_limits_are_top_k(spark, small):
    vp = V.vehicle_positions(spark, small)
    assert "TakeOrderedAndProject" in plan(events.latest_positions(vp, "2024-01-30T00:00:00Z", limit=500))


def test_append_reduces_the_batch_first(spark, small):
    line = V.table(spark, small, "lineitem").select("l_orderkey", "l_linenumber")
    text = plan(merges.append_new(line, line, ["l_orderkey", "l_linenumber"]))
    assert text.count("FileScan") == 2 and "LeftAnti" in text


def test_a_silent_feed_reads_no_older_day_than_its_last(spark, tmp_path):
    days = [datetime(2026, 4, d, 10) for d in range(1, 15)]
    ddl = "received_at timestamp, feed_timestamp timestamp, agency_id string, vehicle_id string, latitude double, longitude double"
    rows = [(t, t, "ttc" if t.day <= 11 else "other", "v", 43.0, -79.0) for t in days]
    batch = spark.createDataFrame(rows, ddl)
    for c in S.VEHICLE_POSITIONS.schema:
        if c.name not in batch.columns:
            batch = batch.withColumn(c.name, F.lit(None).cast(c.dataType))
    tables.append_events(spark, str(tmp_path), S.VEHICLE_POSITIONS, batch)
    noon = datetime(2026, 4, 14, 12, tzinfo=timezone.utc)
    row = stored_freshness(spark, str(tmp_path), S.VEHICLE_POSITIONS, "f", noon)
    assert row.first()["last_record_at"] == datetime(2026, 4, 11, 10)
    filters = re.search(r"PartitionFilters: \[(.*?)\], ", plan(row)).group(1)
    assert ">= 2026-04-08" in filters, filters
    never = stored_freshness(spark, str(tmp_path), S.VEHICLE_POSITIONS, "f", noon, agency_id="none")
    assert never.first()["status"] == "down"


def test_routes_are_resolved_in_few_shuffles(spark, small):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(QUERIES["resolve_routes"](spark, small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # Of these, queries and keys appear twice: once more for the lengths of open queries.
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 9
