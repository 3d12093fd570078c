"""Freshness, static typing, checks, merges, retention, services, health."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stopclock.functions import text as X
from stopclock.functions import times as M
from stopclock.operators import dead_letters, events, freshness, health, merges, quality
from stopclock.operators import retention, services, static_tables

NOON = "2026-04-14T12:00:00Z"


@pytest.mark.parametrize(
    "feed, lag, expected",
    [
        ("ttc.trip_updates", 60, "healthy"), ("ttc.trip_updates", 61, "lagging"),
        ("ttc.trip_updates", 180, "lagging"), ("ttc.trip_updates", 181, "stale"),
        ("ttc.trip_updates", 600, "stale"), ("ttc.trip_updates", 601, "down"),
        ("ttc.service_alerts", 600, "healthy"), ("ttc.service_alerts", 1801, "stale"),
        ("ttc.service_alerts", 3601, "down"), ("unknown", 61, "lagging"), ("unknown", None, "down"),
    ],
)
def test_status(spark, feed, lag, expected):
    df = spark.createDataFrame([(feed, lag)], "f string, l int")
    assert df.select(freshness.status_from_lag(F.col("f"), F.col("l"))).first()[0] == expected


def rows_at(spark, *times, agency="ttc"):
    df = spark.createDataFrame([(t, agency) for t in times], "t string, agency_id string")
    return df.withColumn("received_at", F.col("t").cast("timestamp"))


def test_freshness(spark):
    df = rows_at(
        spark, "2026-04-14 11:55:00", "2026-04-14 11:55:01", "2026-04-14 11:00:00",
        "2026-04-14 11:00:01", "2026-04-14 12:00:00.5",
    ).unionByName(rows_at(spark, "2026-04-14 11:59:59", agency="other"))
    row = freshness.freshness(df, "ttc.trip_updates", NOON).first()
    assert row.last_record_at == datetime(2026, 4, 14, 11, 55, 1)
    assert (row.record_count_5min, row.record_count_1h) == (1, 3)
    assert (row.lag_seconds, row.status) == (299, "stale")


def test_freshness_of_nothing_is_down(spark):
    row = freshness.freshness(rows_at(spark).limit(0), "x", NOON).first()
    assert (row.last_record_at, row.record_count_1h, row.lag_seconds, row.status) == (None, 0, None, "down")


def test_daily_counts_are_half_open_utc_days(spark):
    df = rows_at(spark, "2026-04-13 23:59:59.999999", "2026-04-14 00:00:00", "2026-03-31 12:00:00", "2026-03-31 11:59:59")
    got = [tuple(r) for r in events.daily_counts({"f": df, "e": df.limit(0)}, NOON).collect()]
    assert got == [("2026-04-14", "f", 1), ("2026-04-13", "f", 1), ("2026-03-31", "f", 1)]


def test_limits(spark):
    for bad in (0, 5001):
        with pytest.raises(ValueError):
            events.latest_positions(rows_at(spark), NOON, limit=bad)
    for bad in (0, 201):
        with pytest.raises(ValueError):
            health.recent_runs(rows_at(spark), bad)


def test_scalars(spark):
    df = spark.createDataFrame(
        [(" 2 ", "x"), ("", " 1\t"), ("two", "0"), (None, None), ("25:30:00", "20260414"), ("1:2", "20261341")],
        "a string, b string",
    )
    got = df.select(
        X.int_or_null(F.col("a")), X.malformed(F.col("a"), X.int_or_null(F.col("a"))),
        X.flag(F.col("b")), M.gtfs_seconds(F.col("a")), M.compact_date(F.col("b")),
    ).collect()
    assert [tuple(r) for r in got] == [
        (2, False, False, None, None), (None, False, True, None, None),
        (None, True, False, None, None), (None, False, False, None, None),
        (None, True, False, 91800, date(2026, 4, 14)), (None, True, False, None, None),
    ]


@pytest.mark.parametrize(
    "day, seconds, expected",
    [
        ("2026-04-14", 91_800, "2026-04-15 05:30:00"),
        ("2026-03-08", 12 * 3600, "2026-03-08 16:00:00"),
        ("2026-03-08", 0, "2026-03-08 04:00:00"),
        ("2026-11-01", 12 * 3600, "2026-11-01 17:00:00"),
        ("2026-11-01", 0, "2026-11-01 05:00:00"),
    ],
)
def test_scheduled_at_over_clock_changes(spark, day, seconds, expected):
    df = spark.createDataFrame([(day, seconds)], "d string, s int")
    at = M.scheduled_at(F.col("d").cast("date"), F.col("s"), F.lit("America/Toronto"))
    assert str(df.select(at).first()[0]) == expected


def test_latest_per_key_ties(spark):
    df = spark.createDataFrame([("v", 1, "a"), ("v", 1, "b"), ("w", 0, "c")], "k string, t int, h string")
    got = events.latest_per_key(df, ["k"], [F.col("t").desc(), F.col("h").desc()]).orderBy("k").collect()
    assert [(r.k, r.h) for r in got] == [("v", "b"), ("w", "c")]


# --- merges -----------------------------------------------------------------------------

ALERT = "id string, first_seen int, last_seen int, body string"


def test_alert_sequence(spark):
    """New, changed, vanished, and the same id twice in one poll."""
    def poll(*rows):
        return spark.createDataFrame(list(rows), ALERT + ", position int")

    current = spark.createDataFrame([], ALERT)
    polls = [
        poll(("a", 1, 1, "old", 0), ("b", 1, 1, "b", 1)),
        poll(("a", 2, 2, "first", 0), ("a", 2, 2, None, 1)),
        poll(("c", 3, 3, "c", 0)),
    ]
    for p in polls + polls[2:]:
        current = merges.upsert_keep_first(
            current, p, ["id"], keep=["first_seen"], order=["last_seen", "position"]
        )
    got = sorted(tuple(r) for r in current.collect())
    assert got == [("a", 1, 2, None), ("b", 1, 1, "b"), ("c", 3, 3, "c")]
    at_once = polls[0].unionByName(polls[1]).unionByName(polls[2])
    same = merges.upsert_keep_first(
        spark.createDataFrame([], ALERT), at_once, ["id"], keep=["first_seen"], order=["last_seen", "position"]
    )
    assert sorted(tuple(r) for r in same.collect()) == got


def test_append_new_skips_known_and_repeated(spark):
    ddl = "k int, v string"
    current = spark.createDataFrame([(1, "x")], ddl)
    batch = spark.createDataFrame([(1, "y"), (2, "b"), (2, "a")], ddl)
    got = merges.append_new(current, batch, ["k"], [F.col("v")]).collect()
    assert [tuple(r) for r in got] == [(2, "a")]


# --- checks -----------------------------------------------------------------------------


def test_key_checks(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "p int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert [tuple(r) for r in quality.fk_violations(child, parent, ["p"], ["id"]).collect()] == [(2, 2)]
    assert [tuple(r) for r in quality.key_violations(child, ["p"]).collect()] == [(2, 2)]
    assert [tuple(r) for r in quality.null_violations(child, ["p"]).collect()] == [("p", 1)]


def test_scorecard_of_nothing(spark):
    empty = spark.createDataFrame([], "a int")
    card = quality.dq_scorecard(empty, {("validity", "a"): F.col("a") > 0}, {"a": ["a"]})
    assert [(r.n_rows, r.n_passed, r.score) for r in card.collect()] == [(0, 0, None)] * 2


def test_dead_letter_limits_and_identity(spark):
    df = spark.createDataFrame([("m" * 3000, b"p" * 5000), ("short", b"p" * 4096), ("none", None)], "m string, p binary")
    letters = dead_letters.dead_letter(
        df, "f", F.lit("E"), F.col("m"), F.col("p"), M.instant(NOON)
    )
    got = {r.error_message[:5]: r for r in letters.collect()}
    assert len(got["mmmmm"].error_message) == 2000
    assert (len(got["mmmmm"].sample_payload), got["mmmmm"].sample_payload_truncated) == (4096, True)
    assert (len(got["short"].sample_payload), got["short"].sample_payload_truncated) == (4096, False)
    assert (got["none"].sample_payload, got["none"].sample_payload_truncated) == (None, False)
    again = {r.failure_id for r in letters.repartition(3).collect()}
    assert again == {r.failure_id for r in got.values()} and len(again) == 3


def test_retention_names(spark):
    names = ["trip_updates_p20260601", "trip_updates_p20260610", "trip_updates_p20260607",
             "trip_updates_p20261341", "trip_updates_backup", "other_p20200101", "trip_updates_p2026060"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r.name for r in retention.expired_partitions(df, "trip_updates", "2026-06-10").collect()]
    assert got == ["trip_updates_p20260601"]
    assert df.select(retention.partition_name("b", F.lit("2026-06-01").cast("date"))).first()[0] == "b_p20260601"


def test_service_days(spark):
    week = {d: "1" if d not in ("saturday", "sunday") else "0" for d in static_tables.S.WEEKDAYS}
    raw = spark.createDataFrame([("wk", *week.values(), "20260401", "20261231")],
                                "service_id string, " + ", ".join(f"{d} string" for d in week) + ", start_date string, end_date string")
    calendar = static_tables.type_calendar(raw, "2026-04-01")
    dates = spark.createDataFrame(
        [("wk", "20260418", "1"), ("wk", "20260415", "2"), ("only", "20260414", "1"), ("wk", "20260701", "2")],
        "service_id string, date string, exception_type string",
    )
    exceptions = static_tables.type_calendar_dates(dates, "2026-04-01")
    got = services.active_services(calendar, exceptions, "2026-04-13", "2026-04-19").collect()
    days = sorted((r.service_id, str(r.service_date)[8:]) for r in got)
    assert days == [("only", "14"), ("wk", "13"), ("wk", "14"), ("wk", "16"), ("wk", "17"), ("wk", "18")]


def test_feed_health(spark):
    runs = spark.createDataFrame(
        [("a", "success", "2026-04-14 11:00:00"), ("a", "failure", "2026-04-14 10:00:00"),
         ("a", "running", "2026-04-14 11:59:00"), ("a", "failure", "2026-04-12 10:00:00")],
        "asset_key string, status string, t string",
    ).withColumn("started_at", F.col("t").cast("timestamp"))
    signed = spark.createDataFrame([("b", "h", "2026-04-14 01:00:00")], "feed_key string, signature_hash string, t string")
    signed = signed.withColumn("first_seen_at", F.col("t").cast("timestamp"))
    got = {r.feed_key: r for r in health.feed_health(runs, signed, NOON).collect()}
    assert (got["a"].n_runs, got["a"].success_rate, got["a"].drifted) == (2, 0.5, False)
    assert (got["b"].n_runs, got["b"].success_rate, got["b"].drifted) == (0, None, True)
