"""Poll files made of the driver's tables, landed, ingested and read back.

A poll holds one day of events or one turn of all conversations.  Files are landed in four
steps: the middle of the polls first, then the rest with one poll late, and at last some polls
once more under other file names.  The ingest takes a few files at a time, so a feed goes
through many micro-batches.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import registry as R
from checks import views as V
from stopclock import schemas as S
from stopclock.operators import feed_rows, health, merges
from stopclock.plans import tables
from stopclock.plans.buckets import merge_buckets, read_buckets
from stopclock.plans.reports import record_freshness
from stopclock.session import scratch_path
from stopclock.sources.feeds import scan_feed_snapshots
from stopclock.streaming import ingest

query = R.query
DAY_S = 86_400
#: Files that one micro-batch takes.
FILES = 10
#: Tasks that polls are dealt over at most.
MOST_TASKS = 1024


def _poll_of_day() -> Column:
    return (F.floor(F.unix_seconds(V.ts("ts")) / DAY_S) + 1) * DAY_S


_POLL_OF_DAY = f"CAST((epoch_us(ts) // 1000000 // {DAY_S} + 1) * {DAY_S} AS BIGINT)"


def _polls(rows: DataFrame) -> DataFrame:
    """poll, line, content: rows (poll, entity) as one message a poll, an entity a line, so that
    no task holds a message."""
    header = F.to_json(F.struct(F.struct(F.col("poll").cast("string").alias("timestamp")).alias("header")))
    opened = F.concat(F.expr("substring(h, 1, length(h) - 1)"), F.lit(',"entity":['))
    line = F.row_number().over(Window.partitionBy("poll").orderBy("entity"))
    first = F.when(F.col("line") == 1, opened).otherwise(",")
    lines = rows.withColumns({"line": line, "h": header}).select(
        "poll", F.col("line").cast("long").alias("line"), F.concat(first, F.to_json("entity")).alias("content")
    )
    ends = rows.select("poll").distinct().select("poll", F.lit(2**62).alias("line"), F.lit("]}").alias("content"))
    return lines.unionByName(ends)


def position_polls(spark: SparkSession, d: str) -> DataFrame:
    e = V.table(spark, d, "events")
    i, u = F.col("event_id"), F.col("user_id")
    vehicle = F.struct(
        F.struct(i.cast("string").alias("id")).alias("vehicle"),
        F.struct(F.expr("event_id div 3").cast("string").alias("trip_id"), F.col("event_type").alias("route_id")).alias("trip"),
        F.struct(
            (F.lit(43.5) + (u * 37 % 1000) / 2000).cast("float").alias("latitude"),
            (F.lit(-79.6) + (u * 91 % 1000) / 2000).cast("float").alias("longitude"),
        ).alias("position"),
        F.when(i % 3 == 0, F.lit("STOPPED_AT")).otherwise("IN_TRANSIT_TO").alias("current_status"),
        (i % 7).cast("int").alias("current_stop_sequence"),
    )
    return _polls(e.select(_poll_of_day().alias("poll"), F.struct(i.cast("string").alias("id"), vehicle.alias("vehicle")).alias("entity")))


def trip_polls(spark: SparkSession, d: str) -> DataFrame:
    e = V.table(spark, d, "events")
    i = F.col("event_id")
    stop = F.struct(
        (i % 7).cast("int").alias("stop_sequence"),
        (F.col("user_id") % 5).cast("string").alias("stop_id"),
        F.struct(F.unix_seconds(V.ts("ts")).cast("string").alias("time")).alias("arrival"),
    )
    trip = F.struct(
        F.expr("event_id div 3").cast("string").alias("trip_id"),
        F.col("event_type").alias("route_id"),
        F.date_format(V.ts("ts"), "yyyyMMdd").alias("start_date"),
    )
    update = F.struct(trip.alias("trip"), F.array(stop).alias("stop_time_update"))
    return _polls(e.select(_poll_of_day().alias("poll"), F.struct(i.cast("string").alias("id"), update.alias("trip_update")).alias("entity")))


def alert_polls(spark: SparkSession, d: str) -> DataFrame:
    c = V.table(spark, d, "conversations")
    text = F.struct(F.col("text").alias("text"), F.lit("en").alias("language"))
    alert = F.struct(
        F.lit("MAINTENANCE").alias("cause"),
        F.struct(F.array(text).alias("translation")).alias("header_text"),
        F.array(F.struct(F.concat(F.lit("r"), F.col("turn")).alias("route_id"))).alias("informed_entity"),
    )
    poll = F.lit(1_700_000_000) + F.col("turn") * 60
    return _polls(c.select(poll.alias("poll"), F.struct(F.col("conv_id").cast("string").alias("id"), alert.alias("alert")).alias("entity")))


def land_files(spark: SparkSession, polls: DataFrame, label: str) -> str:
    """Land poll files as described above; returns the pattern of their folders.  The lines of
    a poll, where there are several, are written in their order."""
    if "line" not in polls.columns:
        polls = polls.withColumn("line", F.lit(0))
    folder = scratch_path(spark, label)
    number = F.col("poll") / F.when(F.col("poll") % DAY_S == 0, F.lit(DAY_S)).otherwise(60)
    n = F.pmod(F.floor(number), F.lit(10))
    late = n == 4
    # A poll to a task, which neither Spark's merging of small partitions nor a hash changes.
    least, most = polls.agg(F.min(number), F.max(number)).first()
    tasks = min(int(most - least) + 1, MOST_TASKS) if least is not None else 1
    polls = polls.repartitionById(tasks, F.pmod(F.floor(number), F.lit(tasks)).cast("int")).persist()
    steps = (n.between(2, 6) & ~late, n > 6, (n < 2) | late, n.isin(3, 8))
    for step in steps:
        rows = polls.filter(step).sortWithinPartitions("poll", "line")
        rows.select("poll", F.col("content").alias("value")).write.mode("append").partitionBy("poll").text(folder)
    polls.unpersist()
    return f"{folder}/poll=*"


def ingested(spark: SparkSession, polls: DataFrame, feed: str) -> str:
    """Root of a store that the landed polls were streamed into, the stream run twice."""
    landing = land_files(spark, polls, f"landing-{feed}")
    root, state = scratch_path(spark, "ingested"), scratch_path(spark, "ingest-state")
    for _ in range(2):
        query = ingest.ingest_stream(
            spark, landing, root, feed, state, trigger={"availableNow": True}, pattern="part-*", max_files=FILES
        )
        query.awaitTermination()
    return root


_VEHICLES = f"""SELECT make_timestamp({_POLL_OF_DAY} * 1000000) AS received_at,
    CAST(event_id AS VARCHAR) AS vehicle_id, CAST(event_id // 3 AS VARCHAR) AS trip_id, event_type AS route_id,
    CAST(CAST(43.5 + CAST(user_id * 37 % 1000 AS DOUBLE) / 2000 AS FLOAT) AS DOUBLE) AS latitude,
    CAST(CAST(-79.6 + CAST(user_id * 91 % 1000 AS DOUBLE) / 2000 AS FLOAT) AS DOUBLE) AS longitude,
    CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS current_status,
    CAST(event_id % 7 AS INTEGER) AS current_stop_sequence FROM events"""


@query(
    "scan_feed_snapshots",
    f"""SELECT make_timestamp({_POLL_OF_DAY} * 1000000) AS received_at, count(*) AS n_entities,
      CAST({_POLL_OF_DAY} AS VARCHAR) AS feed_epoch, CAST(NULL AS VARCHAR) AS reject_reason
    FROM events GROUP BY ALL""",
)
def _(spark, d):
    """Poll files as landed, the repeated ones counted once."""
    landing = land_files(spark, position_polls(spark, d), "landing")
    polls = scan_feed_snapshots(spark, landing, pattern="part-*")
    pieces = polls.select(
        "payload_hash", "piece", "received_at", F.size("entity").cast("long").alias("n"),
        F.col("header.timestamp").alias("feed_epoch"), "reject_reason",
    )
    return (
        pieces.dropDuplicates(["payload_hash", "piece"]).groupBy("payload_hash")
        .agg(
            F.min("received_at").alias("received_at"), F.sum("n").alias("n_entities"),
            F.min("feed_epoch").alias("feed_epoch"), F.max("reject_reason").alias("reject_reason"),
        )
        .drop("payload_hash")
    )


@query("ingest_positions", _VEHICLES)
def _(spark, d):
    root = ingested(spark, position_polls(spark, d), "vehicle_positions")
    stored = tables.read_events(spark, root, S.VEHICLE_POSITIONS)
    return stored.select(
        "received_at", "vehicle_id", "trip_id", "route_id", "latitude", "longitude", "current_status",
        "current_stop_sequence",
    )


@query(
    "ingest_trip_updates",
    f"""SELECT make_timestamp({_POLL_OF_DAY} * 1000000) AS received_at, CAST(event_id // 3 AS VARCHAR) AS trip_id,
      event_type AS route_id, strftime(ts, '%Y-%m-%d') AS start_date, CAST(event_id % 7 AS INTEGER) AS stop_sequence,
      CAST(user_id % 5 AS VARCHAR) AS stop_id, date_trunc('second', ts) AS arrival_time FROM events""",
)
def _(spark, d):
    root = ingested(spark, trip_polls(spark, d), "trip_updates")
    stored = tables.read_events(spark, root, S.TRIP_UPDATES)
    return stored.select(
        "received_at", "trip_id", "route_id", "start_date", "stop_sequence", "stop_id", "arrival_time"
    )


@query(
    "ingest_alerts",
    """SELECT CAST(conv_id AS VARCHAR) AS alert_id, make_timestamp((1700000000 + min(turn) * 60) * 1000000) AS first_seen_at,
      make_timestamp((1700000000 + max(turn) * 60) * 1000000) AS last_seen_at, arg_max(text, turn) AS header_text,
      'r' || max(turn) AS affected_routes FROM conversations GROUP BY conv_id""",
)
def _(spark, d):
    root = ingested(spark, alert_polls(spark, d), "service_alerts")
    stored = read_buckets(spark, root, S.SERVICE_ALERTS)
    routes = F.array_join("affected_routes", ",").alias("affected_routes")
    return stored.select("alert_id", "first_seen_at", "last_seen_at", "header_text", routes)


@query(
    "ingest_signatures",
    f"""SELECT 'ttc.vehicle_positions' AS feed_key, count(DISTINCT {_POLL_OF_DAY}) AS sample_count,
      make_timestamp(min({_POLL_OF_DAY}) * 1000000) AS first_seen_at,
      make_timestamp(max({_POLL_OF_DAY}) * 1000000) AS last_seen_at FROM events""",
)
def _(spark, d):
    """The one signature of polls that all have the same fields: a poll is a sample once."""
    root = ingested(spark, position_polls(spark, d), "vehicle_positions")
    stored = tables.read_keyed(spark, root, S.SIGNATURES, part="vehicle_positions")
    return stored.select("feed_key", "sample_count", "first_seen_at", "last_seen_at")


_PARTS = 4


@query(
    "recent_runs_stored",
    f"""WITH p AS (SELECT {_POLL_OF_DAY} AS poll, count(*) AS n FROM events GROUP BY 1),
      r AS (SELECT sum(n) AS n FROM p GROUP BY poll // {DAY_S} % {_PARTS})
    SELECT 'ttc.vehicle_positions' AS asset_key, 'success' AS status, CAST(n AS BIGINT) AS records_written FROM r
    UNION ALL SELECT 'ttc.vehicle_positions', 'success', 0
    UNION ALL SELECT 'ttc.vehicle_positions', 'failure', NULL""",
)
def _(spark, d):
    """The log of four ingest runs, one of them again, and one that failed."""
    landing = land_files(spark, position_polls(spark, d), "landing")
    polls = scan_feed_snapshots(spark, landing, pattern="part-*")
    part = F.pmod(F.floor(F.unix_seconds("received_at") / DAY_S), F.lit(_PARTS))
    root = scratch_path(spark, "logged")
    for n in (*range(_PARTS), 0):
        ingest.ingest_polls(spark, polls.filter(part == n), root, "vehicle_positions")
    broken = polls.withColumn("reject_reason", F.raise_error(F.lit("unreadable")).cast("string"))
    try:
        ingest.ingest_polls(spark, broken, root, "vehicle_positions")
    except Exception as e:
        if "unreadable" not in str(e):
            raise
    runs = tables.read_events(spark, root, S.RUNS)
    return health.recent_runs(runs).select("asset_key", "status", "records_written")


@query(
    "record_freshness",
    f"""WITH polls AS (SELECT make_timestamp({_POLL_OF_DAY} * 1000000) AS t FROM events),
      moments AS (SELECT unnest([TIMESTAMP '2024-01-21 00:03:00', TIMESTAMP '2024-01-21 00:45:00']) AS snapshot_at),
      m AS (SELECT snapshot_at, max(t) AS last_record_at,
          count(*) FILTER (t > snapshot_at - INTERVAL 5 MINUTE) AS record_count_5min,
          count(*) FILTER (t > snapshot_at - INTERVAL 1 HOUR) AS record_count_1h
        FROM polls, moments WHERE t <= snapshot_at GROUP BY 1),
      g AS (SELECT *, CAST((epoch_us(snapshot_at) - epoch_us(last_record_at)) // 1000000 AS INTEGER) AS lag_seconds FROM m)
    SELECT snapshot_at, 'ttc.vehicle_positions' AS feed_key, last_record_at, record_count_5min, record_count_1h, lag_seconds,
      CASE WHEN lag_seconds <= 60 THEN 'healthy' WHEN lag_seconds <= 180 THEN 'lagging'
        WHEN lag_seconds <= 600 THEN 'stale' ELSE 'down' END AS status FROM g
    UNION ALL SELECT snapshot_at, f, NULL, 0, 0, NULL, 'down'
      FROM moments, (SELECT unnest(['ttc.trip_updates', 'ttc.service_alerts']) AS f)""",
)
def _(spark, d):
    """The freshness history of a store that has one feed of three, checked twice, the second
    check once more."""
    landing, root = land_files(spark, position_polls(spark, d), "landing"), scratch_path(spark, "checked")
    ingest.ingest_polls(spark, scan_feed_snapshots(spark, landing, pattern="part-*"), root, "vehicle_positions")
    for minute in (3, 45, 45):
        record_freshness(spark, root, datetime(2024, 1, 21, 0, minute, tzinfo=timezone.utc))
    return tables.read_events(spark, root, S.FRESHNESS).drop("dt")


@query(
    "merge_keyed_buckets",
    R.ORACLES["merge_alert_polls"],
)
def _(spark, d):
    """Alert polls merged into a bucketed table in four batches, the last one twice."""
    root = scratch_path(spark, "buckets")
    rows = feed_rows.service_alert_rows(V.alert_messages(spark, d), keep_position=True)

    def merge(current: DataFrame, batch: DataFrame) -> DataFrame:
        return merges.upsert_keep_first(
            current, batch, S.SERVICE_ALERTS.key, order=("last_seen_at", "position"), newer="last_seen_at"
        )

    part = F.pmod(F.unix_seconds("last_seen_at") / 60, F.lit(4)).cast("int")
    for n in (2, 0, 3, 1, 1):
        merge_buckets(spark, root, S.SERVICE_ALERTS, rows.filter(part == n), merge, token=str(n), buckets=8)
    return read_buckets(spark, root, S.SERVICE_ALERTS).select(
        "agency_id", "alert_id", "first_seen_at", "last_seen_at", "header_text",
        F.array_join("affected_stops", ",").alias("affected_stops"),
    )
