"""Queries that write and read back, or run as a stream to the end of its input.

They work in a fresh folder below the session's shared one and return what a reader of
the result sees.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from checks import registry as R
from checks import views as V
from stopclock import schemas as S
from stopclock.functions.times import utc_day
from stopclock.operators import delay, events, feed_rows, merges
from stopclock.plans import delays, export, snapshot, tables
from stopclock.plans.reports import stored_freshness
from stopclock.session import scratch_path
from stopclock.sources import cold
from stopclock.sources.payloads import decode_feed_payloads
from stopclock.streaming import delay_state, freshness, ingest, throttle
from stopclock.streaming.progress import dropped_rows

query, newest = R.query, R.newest
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

_POSITION = R._POSITION


# --- stored tables ----------------------------------------------------------------------


@query(
    "append_events",
    f"WITH {V.VP} SELECT {_POSITION}, raw_payload_hash FROM vp",
)
def _(spark, d):
    """Two overlapping batches, one of them twice."""
    root = scratch_path(spark, "append")
    vp = V.vehicle_positions(spark, d)
    first, second = (vp.filter(c) for c in ("current_status < 2", "current_status > 0"))
    for batch in (first, second, second):
        tables.append_events(spark, root, S.VEHICLE_POSITIONS, batch)
    stored = tables.read_events(spark, root, S.VEHICLE_POSITIONS)
    return stored.select(*events.POSITION_COLUMNS, "raw_payload_hash")


@query(
    "export_days",
    f"""WITH {V.VP} SELECT {_POSITION}, strftime(received_at, '%Y-%m-%d') AS dt FROM vp
    WHERE received_at >= TIMESTAMP '2024-01-10' AND received_at < TIMESTAMP '2024-01-13'""",
)
def _(spark, d):
    """Three days exported, the middle one twice, read back from the archive."""
    root = scratch_path(spark, "archive")
    vp = V.vehicle_positions(spark, d)
    for day in (10, 11, 12, 11):
        export.export_day(vp, root, "vehicle_positions", date(2024, 1, day))
    days = cold.scan_cold(spark, root, "vehicle_positions", "2024-01-10", "2024-01-12")
    return days.select(*events.POSITION_COLUMNS, "dt")


@query(
    "verify_export",
    """WITH n AS (SELECT count(*) AS n FROM events WHERE CAST(ts AS DATE) = '2024-01-15')
    SELECT 'rows' AS "check", n AS expected, n AS found, true AS passed FROM n
    UNION ALL SELECT 'columns', 18, 18, true
    UNION ALL SELECT 'rows_of_other_days', 0, 0, true""",
)
def _(spark, d):
    root = scratch_path(spark, "archive")
    vp = V.vehicle_positions(spark, d)
    done = export.export_day(vp, root, "vehicle_positions", date(2024, 1, 15))
    return export.verify_export(spark, root, "vehicle_positions", date(2024, 1, 15), done["rows"])


@query(
    "export_summary",
    """WITH days AS (SELECT unnest(['2024-01-10', '2024-01-11', '2024-01-29', '2023-05-01']) AS day),
      n AS (SELECT day, count(event_id) AS n FROM days LEFT JOIN events ON strftime(ts, '%Y-%m-%d') = day GROUP BY 1)
    SELECT 'vehicle_positions' AS feed, day, CASE WHEN n > 0 THEN 'ok' ELSE 'skipped_no_data' END AS status,
      n AS n_rows, n > 0 AS has_bytes FROM n
    UNION ALL SELECT 'vehicle_positions', '2024-01-10', 'skipped_no_target', 0, false""",
)
def _(spark, d):
    """What the export reports: days with rows, one without, and a run without a target."""
    root, vp = scratch_path(spark, "archive"), V.vehicle_positions(spark, d)
    days = (date(2024, 1, 10), date(2024, 1, 11), date(2024, 1, 29), date(2023, 5, 1))
    done = [export.export_day(vp, root, "vehicle_positions", day) for day in days]
    done.append(export.export_day(vp, None, "vehicle_positions", days[0]))
    rows = [(r["feed"], r["day"], r["status"], r["rows"], r["bytes"] > 0) for r in done]
    return spark.createDataFrame(rows, "feed string, day string, status string, n_rows bigint, has_bytes boolean")


@query(
    "drop_days",
    """SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS dt, count(*) AS n_rows FROM events
    WHERE CAST(ts AS DATE) >= (SELECT CAST(max(ts) AS DATE) - 3 FROM events) GROUP BY 1""",
)
def _(spark, d):
    """What is left of a stored table after retention."""
    root = scratch_path(spark, "hot")
    vp = V.vehicle_positions(spark, d)
    tables.append_events(spark, root, S.VEHICLE_POSITIONS, vp)
    today = vp.agg(F.max(utc_day("received_at"))).first()[0]
    export.drop_days(spark, root, "vehicle_positions", today)
    left = tables.read_events(spark, root, S.VEHICLE_POSITIONS)
    return left.groupBy("dt").agg(F.count("*").alias("n_rows"))


@query(
    "stored_freshness",
    """WITH m AS (SELECT count(*) FILTER (ts > TIMESTAMP '2024-01-20 11:55:00') AS a,
        count(*) FILTER (ts > TIMESTAMP '2024-01-20 11:00:00') AS b, max(ts) AS t FROM events
        WHERE ts <= TIMESTAMP '2024-01-20 12:00:00'),
      n AS (SELECT *, CAST((epoch_us(TIMESTAMP '2024-01-20 12:00:00') - epoch_us(t)) // 1000000 AS INTEGER)
        AS lag FROM m)
    SELECT TIMESTAMP '2024-01-20 12:00:00' AS snapshot_at, 'ttc.trip_updates' AS feed_key,
      t AS last_record_at, a AS record_count_5min, b AS record_count_1h, lag AS lag_seconds,
      CASE WHEN lag <= 60 THEN 'healthy' WHEN lag <= 180 THEN 'lagging' WHEN lag <= 600 THEN 'stale'
        ELSE 'down' END AS status FROM n""",
)
def _(spark, d):
    root = scratch_path(spark, "hot")
    tables.append_events(spark, root, S.TRIP_UPDATES, V.trip_updates(spark, d))
    noon = datetime(2024, 1, 20, 12, tzinfo=timezone.utc)
    return stored_freshness(spark, root, S.TRIP_UPDATES, "ttc.trip_updates", noon)


@query(
    "merge_keyed",
    """SELECT CAST(conv_id AS VARCHAR) AS alert_id,
      make_timestamp((1700000000 + conv_id * 1000 + min(turn) * 60) * 1000000) AS first_seen_at,
      make_timestamp((1700000000 + conv_id * 1000 + max(turn) * 60) * 1000000) AS last_seen_at,
      arg_max(text, turn) AS header_text FROM conversations GROUP BY conv_id""",
)
def _(spark, d):
    """Alert polls merged into a stored table in three batches, the last one twice."""
    root = scratch_path(spark, "alerts")
    rows = feed_rows.service_alert_rows(V.alert_messages(spark, d), keep_position=True)

    def merge(current: DataFrame, batch: DataFrame) -> DataFrame:
        return merges.upsert_keep_first(
            current, batch, S.SERVICE_ALERTS.key, order=("last_seen_at", "position")
        )

    cuts = rows.agg(F.percentile_approx("last_seen_at", [0.3, 0.7])).first()[0]
    seen = F.col("last_seen_at")
    parts = (seen < F.lit(cuts[0]), (seen >= F.lit(cuts[0])) & (seen < F.lit(cuts[1])), seen >= F.lit(cuts[1]))
    for n, part in enumerate((*parts, parts[2])):
        tables.merge_keyed(spark, root, S.SERVICE_ALERTS, rows.filter(part), merge, token=str(min(n, 2)))
    stored = tables.read_keyed(spark, root, S.SERVICE_ALERTS)
    return stored.select("alert_id", "first_seen_at", "last_seen_at", "header_text")


@query(
    "decode_feed_payloads",
    f"SELECT * EXCLUDE (raw_payload_hash) FROM ({R.ORACLES['vehicle_position_rows']})",
)
def _(spark, d):
    """The vehicle messages as binary payloads, decoded again."""
    payloads = V.as_payloads(V.position_messages(spark, d))
    rows = feed_rows.vehicle_position_rows(decode_feed_payloads(payloads))
    return rows.drop("congestion_level", "raw_payload_hash")


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("quoteAll", True).csv(path)


def archive_folder(spark: SparkSession, d: str) -> str:
    """The tables as an archive folder of CSV files."""
    folder = scratch_path(spark, "gtfs")
    stops = V.stops(spark, d).withColumnsRenamed({"latitude": "stop_lat", "longitude": "stop_lon"})
    _write_csv(stops, f"{folder}/stops.txt")
    parts = V.table(spark, d, "part")
    _write_csv(
        parts.select(
            F.col("p_partkey").alias("route_id"),
            F.col("p_name").alias("route_long_name"),
            F.lit(" 3 ").alias("route_type"),
        ),
        f"{folder}/routes.txt",
    )
    n_parts = parts.agg(F.count("*")).scalar()
    orders = V.table(spark, d, "orders")
    _write_csv(
        orders.select(
            F.lit("daily").alias("service_id"),
            (F.col("o_orderkey") % n_parts).alias("route_id"),
            F.col("o_orderkey").alias("trip_id"),
        ),
        f"{folder}/trips.txt",
    )
    line = V.stop_times(spark, d)
    at = F.concat_ws(":", F.floor(F.col("arrival_s") / 3600), F.lit("05"), F.lit("09"))
    customers = V.table(spark, d, "customer").agg(F.count("*")).scalar()
    _write_csv(
        line.select(
            "trip_id",
            at.alias("arrival_time"),
            at.alias("departure_time"),
            (F.col("arrival_s") % customers).alias("stop_id"),
            "stop_sequence",
        ),
        f"{folder}/stop_times.txt",
    )
    _write_csv(
        V.table(spark, d, "supplier").select(
            F.col("s_suppkey").alias("agency_id"),
            F.col("s_name").alias("agency_name"),
            F.lit("America/Toronto").alias("agency_timezone"),
        ),
        f"{folder}/agency.txt",
    )
    return folder


@query(
    "load_static",
    """SELECT 'stops' AS table_name, count(*) AS n_rows,
      CAST(sum(length(c_name)) AS BIGINT) AS text_size FROM customer
    UNION ALL SELECT 'routes', count(*), CAST(sum(length(p_name)) AS BIGINT) FROM part
    UNION ALL SELECT 'trips', count(*), 0 FROM orders
    UNION ALL SELECT 'stop_times', count(*), 0 FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
    UNION ALL SELECT 'agency', count(*), CAST(sum(length(s_name)) AS BIGINT) FROM supplier
    UNION ALL SELECT 'calendar', 0, 0 UNION ALL SELECT 'calendar_dates', 0, 0""",
)
def _(spark, d):
    """An archive folder of CSV files loaded, checked and read as the current snapshot."""
    root = scratch_path(spark, "static")
    snapshot.load_static(spark, archive_folder(spark, d), root, date(2026, 4, 14))
    loaded = snapshot.read_snapshot(spark, root)
    names = {"stops": "stop_name", "routes": "route_long_name", "agency": "agency_name"}
    sizes = None
    for name, df in loaded.items():
        size = F.sum(F.length(names[name])) if name in names else F.lit(0)
        row = df.agg(
            F.count("*").alias("n_rows"), F.coalesce(size, F.lit(0)).cast("long").alias("text_size")
        ).select(F.lit(name).alias("table_name"), "n_rows", "text_size")
        sizes = row if sizes is None else sizes.unionByName(row)
    return sizes


@query(
    "load_summary",
    """SELECT 'stops' AS table_name, count(*) AS n_rows FROM customer UNION ALL SELECT 'routes', count(*) FROM part
    UNION ALL SELECT 'trips', count(*) FROM orders UNION ALL SELECT 'agency', count(*) FROM supplier
    UNION ALL SELECT 'stop_times', count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
    UNION ALL SELECT 'calendar', 0 UNION ALL SELECT 'calendar_dates', 0""",
)
def _(spark, d):
    """What the loader reports of its run."""
    counts = snapshot.load_static(spark, archive_folder(spark, d), scratch_path(spark, "static"), date(2026, 4, 14))
    return spark.createDataFrame(sorted(counts.items()), "table_name string, n_rows bigint")


# --- streams ----------------------------------------------------------------------------


#: Files of one slice of a stream's input, which one micro-batch takes.
SLICE_FILES = 4

def event_slices(spark: SparkSession, d: str, again: Column | None = None, marks: int = 0) -> DataFrame:
    """The events as a stream of five or more micro-batches, one a week.  Rows for which
    ``again`` is true come once more, as the last of them.  ``marks`` further ones hold events
    of years after, with negative ids."""
    order = F.floor(F.unix_seconds(V.ts("ts")) / (7 * 86_400))
    events, folder = V.table(spark, d, "events"), scratch_path(spark, "event-slices")
    numbers = sorted(r[0] for r in events.select(order).distinct().collect())  # a handful
    parts = [events.filter(order == n) for n in numbers]
    if again is not None:
        parts.append(events.filter(again))
    for n in range(marks):
        years = F.make_interval(F.lit(1 + n))
        few = events.limit(SLICE_FILES)
        parts.append(few.withColumns({"event_id": -F.abs("event_id") - 1, "ts": F.col("ts") + years}).select(*events.columns))
    for part in parts:
        part.repartition(SLICE_FILES).write.mode("append").parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", SLICE_FILES).parquet(folder)


def run_to_end(df: DataFrame, mode: str) -> DataFrame:
    """All output of a stream over the input there is, with the number of its batch."""
    return ended(df, mode)[0]


def ended(df: DataFrame, mode: str) -> tuple[DataFrame, StreamingQuery]:
    """The output of a stream over the input there is, and the query that made it."""
    spark = df.sparkSession
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(out)

    started = (
        df.writeStream.foreachBatch(land)
        .outputMode(mode)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return spark.read.parquet(out), started


@query(
    "stream_without_repeats",
    "SELECT event_id, ts AS received_at, CAST(user_id AS VARCHAR) AS vehicle_id, value FROM events",
)
def _(spark, d):
    """Weeks of events, each polled twice, the rows of the last days once more at the end."""
    events = event_slices(spark, d, again=V.ts("ts") >= F.lit("2024-01-25 00:00:00 UTC").cast("timestamp"))
    rows = events.select(
        "event_id",
        V.ts("ts").alias("received_at"),
        F.col("user_id").cast("string").alias("vehicle_id"),
        "value",
    )
    polled_twice = rows.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    # Longer than the rows that come again are late.
    kept = ingest.first_per_key(polled_twice, ["received_at", "vehicle_id", "event_id"], delay="10 days")
    return run_to_end(kept, "append").drop("_batch")


@query(
    "stream_late_rows",
    """SELECT count(*) AS kept, count(*) FILTER (ts < TIMESTAMP '2024-01-08') AS dropped FROM events""",
)
def _(spark, d):
    """Weeks of events and, at the end, the first week again: too late for the watermark, so
    its rows are dropped and counted."""
    slices = event_slices(spark, d, again=V.ts("ts") < F.lit("2024-01-08 00:00:00 UTC").cast("timestamp"))
    rows = slices.select("event_id", V.ts("ts").alias("received_at"))
    kept, done = ended(ingest.first_per_key(rows, ["event_id"]), "append")
    return kept.agg(F.count("*").alias("kept")).withColumn("dropped", F.lit(dropped_rows(done)).cast("long"))


@query(
    "stream_rolling_counts",
    """WITH w AS (SELECT event_type AS feed_key, ts,
        time_bucket(INTERVAL 15 MINUTE, ts) - to_minutes(15 * unnest(range(0, 4))) AS window_start FROM events)
    SELECT feed_key, window_start, window_start + INTERVAL 1 HOUR AS window_end,
      count(*) AS record_count, max(ts) AS last_record_at FROM w GROUP BY 1, 2""",
)
def _(spark, d):
    """Counts over five micro-batches, the last state of each window."""
    rows = event_slices(spark, d).select(
        F.col("event_type").alias("feed_key"), V.ts("ts").alias("received_at")
    )
    rolling = freshness.rolling_counts(rows, length="1 hour", step="15 minutes")
    changes = run_to_end(rolling, "update")
    last = events.latest_per_key(changes, ["feed_key", "window_start"], [F.col("_batch").desc()])
    return last.drop("_batch")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """State of the kind that timers and lists need."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def changed_delays(spark: SparkSession, d: str) -> DataFrame:
    """Stream of changed delays over five micro-batches of reports."""
    slices = event_slices(spark, d)
    reports = delay_state.delay_reports(
        V.trip_updates_of(slices), V.vehicle_positions_of(slices), V.stop_times(spark, d), R._ZONE
    )
    return delay_state.live_delays(reports, sweep_minutes=60 * 1440, lateness="0 seconds")


@query("stream_live_delays", R.ORACLES["stop_delays"].replace("7 DAY", "60 DAY"))
def _(spark, d):
    """The streamed delay state after the last report, as the batch job has it."""
    with rocksdb(spark):
        changes = run_to_end(changed_delays(spark, d), "update")
    key = ["start_date", "trip_id", "stop_sequence"]
    last = events.latest_per_key(changes, key, [F.col("_batch").desc()])
    return last.drop("_batch")


def landed_delays(spark: SparkSession, d: str) -> str:
    """Root of a store that the delay stream landed in."""
    root, state = scratch_path(spark, "delays"), scratch_path(spark, "state")
    with rocksdb(spark):
        delays.land_delay_stream(changed_delays(spark, d), root, state).awaitTermination()
    return root


@query("stored_delays", R.ORACLES["stop_delays"].replace("7 DAY", "60 DAY"))
def _(spark, d):
    """The stored delays, one service day compacted: frozen rows and open ones."""
    root = landed_delays(spark, d)
    delays.compact_delays(spark, root, date(2024, 1, 15))
    return delays.read_delays(spark, root)


@query(
    "delay_reliability_stored",
    f"""WITH d AS ({R.ORACLES["stop_delays"]})
    SELECT route_id, start_date AS day,
      CAST(extract(hour FROM scheduled_at AT TIME ZONE 'UTC' AT TIME ZONE '{R._ZONE}') AS INTEGER) AS hour,
      count(*) AS n_visits, round(avg(delay_s), 3) AS avg_delay_s,
      round(quantile_cont(delay_s, 0.5), 3) AS median_delay_s,
      round(quantile_cont(delay_s, 0.9), 3) AS p90_delay_s,
      round(count(*) FILTER (delay_s BETWEEN -60 AND 300) / count(*), 6) AS on_time_share
    FROM d WHERE status = 'final' GROUP BY ALL""",
)
def _(spark, d):
    """Reliability from the history that the delay stream landed in five micro-batches."""
    shares = delay.delay_reliability(delays.read_delays(spark, landed_delays(spark, d)), zone=R._ZONE)
    for c in ("avg_delay_s", "median_delay_s", "p90_delay_s"):
        shares = shares.withColumn(c, F.round(c, 3))
    return shares.withColumn("on_time_share", F.round("on_time_share", 6))


_THROTTLED = """WITH RECURSIVE e AS (SELECT event_id, user_id, ts,
        row_number() OVER (PARTITION BY user_id ORDER BY ts) AS n FROM events),
      s AS (SELECT *, ts AS start, 1 AS used, true AS allowed FROM e WHERE n = 1
        UNION ALL
        SELECT e.*, CASE WHEN e.ts - start >= INTERVAL 2 HOUR THEN e.ts ELSE start END,
          CASE WHEN e.ts - start >= INTERVAL 2 HOUR THEN 1 WHEN used < 2 THEN used + 1 ELSE used END,
          e.ts - start >= INTERVAL 2 HOUR OR used < 2
        FROM s JOIN e ON e.user_id = s.user_id AND e.n = s.n + 1)
    SELECT event_id, user_id, ts, allowed FROM s"""


@query(
    "stream_throttle",
    _THROTTLED,
)
def _(spark, d):
    """Events in five micro-batches and any order inside a day.  Two marks long after the
    last event move the watermark past it."""
    rows = event_slices(spark, d, marks=2).select("event_id", "user_id", V.ts("ts").alias("ts"))
    with rocksdb(spark):
        out = run_to_end(throttle.throttle(rows, "user_id", "ts", 2, 7200, "1 day", 86_400), "append")
    return out.filter("event_id >= 0").drop("_batch")


@query("throttle_batch", _THROTTLED)
def _(spark, d):
    rows = V.table(spark, d, "events").select("event_id", "user_id", V.ts("ts").alias("ts"))
    return throttle.throttle_batch(rows, "user_id", "ts", 2, 7200)

