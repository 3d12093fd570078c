"""Queries over the driver's tables, each with the SQL that must give the same rows.

Every query reads whole tables.  Where a time "now" is needed it is the newest time in
the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as V
from stopclock.functions import text as X
from stopclock.functions import times as M
from stopclock.operators import (
    dead_letters,
    delay,
    events,
    feed_rows,
    freshness,
    geo_join,
    headway,
    health,
    merges,
    names,
    quality,
    retention,
    services,
    signatures,
    static_tables,
)
from stopclock.plans.reports import route_reliability_report
from stopclock.sources import cold, feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, d: V.plain(fn(spark, d))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def newest(df: DataFrame, c: str = "received_at") -> Column:
    return df.agg(F.max(c)).scalar()


# --- headway ----------------------------------------------------------------------------

_ARRIVALS = """arrivals AS (
  SELECT route_id, direction_id, stop_id, trip_id, max(arrival_time) AS arrival_time
  FROM tu WHERE arrival_time IS NOT NULL GROUP BY ALL)"""
_HEADWAYS = """headways AS (
  SELECT *, date_diff('second', date_trunc('second', prev_arrival),
      date_trunc('second', arrival_time)) AS headway_s
  FROM (SELECT route_id, direction_id, stop_id, arrival_time, lag(arrival_time) OVER (
      PARTITION BY route_id, direction_id, stop_id ORDER BY arrival_time) AS prev_arrival
    FROM arrivals))"""
_H = f"WITH {V.TU}, {_ARRIVALS}, {_HEADWAYS}"


def _reliability_sql(key: str, min_gaps: int) -> str:
    return f"""{_H} SELECT {key}, count(*) AS n_gaps, count(DISTINCT stop_id) AS n_stops,
      round(avg(headway_s) / 60, 1) AS avg_headway_min,
      round(stddev_samp(headway_s) / 60, 1) AS stddev_headway_min,
      round(stddev_samp(headway_s) / avg(headway_s), 2) AS headway_cov
    FROM headways WHERE headway_s > 30 AND headway_s < 7200
    GROUP BY ALL HAVING count(*) >= {min_gaps}"""


@query("collapse_arrivals", f"WITH {V.TU}, {_ARRIVALS} SELECT * FROM arrivals")
def _(spark, d):
    return headway.collapse_arrivals(V.trip_updates(spark, d))


@query(
    "collapse_arrivals_newest_per_day",
    f"""WITH {V.TU} SELECT route_id, direction_id, stop_id, trip_id,
      strftime(start_date, '%Y-%m-%d') AS start_date,
      arg_max(arrival_time, received_at) AS arrival_time FROM tu
    GROUP BY ALL""",
)
def _(spark, d):
    return headway.collapse_arrivals(V.trip_updates(spark, d), per_day=True, pick="newest")


@query("headways", f"{_H} SELECT * FROM headways WHERE headway_s > 30 AND headway_s < 7200")
def _(spark, d):
    return headway.headways(headway.collapse_arrivals(V.trip_updates(spark, d)))


@query("route_reliability", _reliability_sql("route_id, direction_id", 30))
def _(spark, d):
    return route_reliability_report(V.trip_updates(spark, d))


@query("route_reliability_any", _reliability_sql("route_id, direction_id", 1))
def _(spark, d):
    return route_reliability_report(V.trip_updates(spark, d), min_gaps=1)


@query(
    "route_reliability_daily",
    _reliability_sql("strftime(arrival_time, '%Y-%m-%d') AS day, route_id, direction_id", 2),
)
def _(spark, d):
    gaps = headway.headways(headway.collapse_arrivals(V.trip_updates(spark, d)))
    return headway.route_reliability_daily(gaps, min_gaps=2)


@query(
    "route_reliability_settled",
    f"""WITH {V.TU.replace('FROM events', "FROM events WHERE ts < (SELECT max(ts) - INTERVAL 1 MINUTE FROM events)")},
    {_ARRIVALS}, {_HEADWAYS} """
    + _reliability_sql("route_id, direction_id", 1).removeprefix(_H),
)
def _(spark, d):
    rows = V.trip_updates(spark, d)
    return route_reliability_report(rows, as_of=newest(rows), min_gaps=1)


# --- latest rows ------------------------------------------------------------------------

_POSITION = (
    "vehicle_id, trip_id, route_id, direction_id, latitude, longitude, bearing, speed_mps, "
    "received_at"
)


def _latest_sql(where: str, limit: int) -> str:
    return f"""WITH {V.VP}, live AS (
      SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY received_at DESC) AS rn
      FROM vp WHERE received_at > (SELECT max(ts) - INTERVAL 1 DAY FROM events) AND {where})
    SELECT {_POSITION} FROM live WHERE rn = 1 ORDER BY vehicle_id LIMIT {limit}"""


@query("latest_positions", _latest_sql("true", 500))
def _(spark, d):
    vp = V.vehicle_positions(spark, d)
    return events.latest_positions(vp, newest(vp), limit=500, minutes=1440)


@query("latest_positions_all", _latest_sql("true", 500).rsplit(" ORDER BY", 1)[0].replace("INTERVAL 1 DAY", "INTERVAL 20 DAY"))
def _(spark, d):
    vp = V.vehicle_positions(spark, d)
    return events.latest_positions(vp, newest(vp), minutes=20 * 1440)


@query("latest_positions_of_route", _latest_sql("route_id = 'click'", 5000))
def _(spark, d):
    vp = V.vehicle_positions(spark, d)
    return events.latest_positions(vp, newest(vp), route_id="click", limit=5000, minutes=1440)


@query(
    "vehicle_history",
    f"WITH {V.VP} SELECT {_POSITION}, raw_payload_hash FROM vp WHERE vehicle_id = '7' "
    "AND received_at >= TIMESTAMP '2024-01-05 12:00:00' AND received_at < TIMESTAMP '2024-01-20'",
)
def _(spark, d):
    vp = V.vehicle_positions(spark, d)
    rows = events.vehicle_history(vp, "7", "2024-01-05T12:00:00Z", "2024-01-20T00:00:00Z")
    return rows.select(*events.POSITION_COLUMNS, "raw_payload_hash")


@query(
    "scan_events",
    f"WITH {V.VP} SELECT {_POSITION} FROM vp WHERE received_at >= TIMESTAMP '2024-01-10 06:30:00' "
    "AND received_at < TIMESTAMP '2024-01-12'",
)
def _(spark, d):
    vp = V.vehicle_positions(spark, d)
    rows = cold.scan_events(vp, "received_at", "2024-01-10T06:30:00Z", "2024-01-12T00:00:00Z")
    return rows.select(*events.POSITION_COLUMNS)


@query(
    "vehicles_in_box",
    f"WITH {V.VP} SELECT {_POSITION} FROM vp WHERE latitude BETWEEN 43.6 AND 43.8 "
    "AND longitude BETWEEN -79.5 AND -79.3",
)
def _(spark, d):
    box = events.vehicles_in_box(V.vehicle_positions(spark, d), 43.6, -79.5, 43.8, -79.3)
    return box.select(*events.POSITION_COLUMNS)


@query(
    "daily_counts",
    f"""WITH {V.VP}, {V.RUNS}, last AS (SELECT max(ts) AS t FROM events)
    SELECT strftime(received_at, '%Y-%m-%d') AS day, 'ttc.vehicle_positions' AS feed_key,
      count(*) AS record_count FROM vp WHERE received_at >= (SELECT t - INTERVAL 14 DAY FROM last)
    GROUP BY ALL UNION ALL
    SELECT strftime(received_at, '%Y-%m-%d'), 'ttc.trip_updates', count(*)
    FROM vp WHERE current_status <> 1 AND received_at >= (SELECT t - INTERVAL 14 DAY FROM last)
    GROUP BY ALL""",
)
def _(spark, d):
    vp = V.vehicle_positions(spark, d)
    feeds_ = {
        "ttc.vehicle_positions": vp,
        "ttc.trip_updates": vp.filter(F.col("current_status") != 1),
    }
    return events.daily_counts(feeds_, newest(vp))


# --- freshness --------------------------------------------------------------------------

_GRADE = """CASE WHEN lag_seconds IS NULL THEN 'down' WHEN lag_seconds <= {0} THEN 'healthy'
  WHEN lag_seconds <= {1} THEN 'lagging' WHEN lag_seconds <= {2} THEN 'stale' ELSE 'down' END"""


def _freshness_sql(feed: str, group: str) -> str:
    return f"""WITH {V.VP}, last AS (SELECT max(ts) AS t FROM events), m AS (
      SELECT {feed} AS feed_key, max(received_at) AS last_record_at,
        count(*) FILTER (received_at > t - INTERVAL 1 HOUR) AS record_count_5min,
        count(*) FILTER (received_at > t - INTERVAL 1 DAY) AS record_count_1h,
        CAST((epoch_us(any_value(t)) - epoch_us(max(received_at))) // 1000000 AS INTEGER) AS lag_seconds
      FROM vp, last WHERE agency_id = 'ttc' {group})
    SELECT (SELECT t FROM last) AS snapshot_at, *, {_GRADE.format(60, 180, 600)} AS status FROM m"""


@query("freshness_of_feed", _freshness_sql("'ttc.vehicle_positions'", ""))
def _(spark, d):
    vp = V.vehicle_positions(spark, d)
    return freshness.freshness(vp, "ttc.vehicle_positions", newest(vp), windows=(60, 1440))


@query("freshness_by_feed", _freshness_sql("route_id", "GROUP BY route_id"))
def _(spark, d):
    vp = V.vehicle_positions(spark, d)
    return freshness.freshness_by(vp, "route_id", newest(vp), windows=(60, 1440))


@query(
    "status_from_lag",
    f"""WITH lags AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN
        CAST(o_custkey * 7 % 4000 AS INTEGER) END AS lag_seconds,
        CASE o_orderstatus WHEN 'F' THEN 'ttc.service_alerts' WHEN 'O' THEN 'ttc.trip_updates'
          ELSE 'other' END AS feed_key FROM orders)
    SELECT *, CASE WHEN feed_key = 'ttc.service_alerts' THEN {_GRADE.format(600, 1800, 3600)}
      ELSE {_GRADE.format(60, 180, 600)} END AS status FROM lags""",
)
def _(spark, d):
    o = V.table(spark, d, "orders")
    feed = (
        F.when(F.col("o_orderstatus") == "F", "ttc.service_alerts")
        .when(F.col("o_orderstatus") == "O", "ttc.trip_updates")
        .otherwise("other")
    )
    lag = F.when(F.col("o_orderkey") % 13 != 0, (F.col("o_custkey") * 7 % 4000).cast("int"))
    lags = o.select("o_orderkey", lag.alias("lag_seconds"), feed.alias("feed_key"))
    return lags.withColumn(
        "status", freshness.status_from_lag(F.col("feed_key"), F.col("lag_seconds"))
    )


@query(
    "latest_freshness",
    f"""WITH {V.HISTORY} SELECT feed_key, last_record_at, record_count_5min, record_count_1h,
      lag_seconds, status FROM history
    QUALIFY row_number() OVER (PARTITION BY feed_key ORDER BY snapshot_at DESC) = 1""",
)
def _(spark, d):
    return freshness.latest_freshness(V.freshness_history(spark, d))


@query(
    "freshness_trend",
    f"""WITH {V.HISTORY} SELECT * FROM history WHERE feed_key = 'error'
      AND snapshot_at > (SELECT max(ts) - INTERVAL 24 HOUR FROM events)""",
)
def _(spark, d):
    history = V.freshness_history(spark, d)
    return freshness.freshness_trend(history, "error", newest(history, "snapshot_at"))


# --- runs, failures, health -------------------------------------------------------------


@query(
    "recent_runs",
    f"WITH {V.RUNS} SELECT run_id, asset_key, started_at, completed_at, status, records_written "
    "FROM runs ORDER BY started_at DESC, run_id LIMIT 50",
)
def _(spark, d):
    return health.recent_runs(V.runs(spark, d))


_SIGNED = """signed AS (SELECT o_orderpriority AS feed_key,
  CAST(o_custkey AS VARCHAR) AS signature_hash, min(CAST(o_orderdate AS TIMESTAMP)) AS first_seen_at
  FROM orders GROUP BY ALL)"""


@query(
    "feed_health",
    f"""WITH {V.RUNS}, {_SIGNED}, last AS (SELECT max(started_at) AS t FROM runs),
    r AS (SELECT asset_key AS feed_key, count(*) AS n_runs,
        count(*) FILTER (status = 'success') AS n_success
      FROM runs, last WHERE status <> 'running' AND started_at > t - INTERVAL 240 HOUR GROUP BY 1),
    s AS (SELECT feed_key, count(*) AS n FROM signed, last
      WHERE first_seen_at > t - INTERVAL 240 HOUR AND first_seen_at <= t GROUP BY 1)
    SELECT feed_key, coalesce(n_runs, 0) AS n_runs, n_success / n_runs AS success_rate,
      coalesce(n, 0) AS n_new_signatures, coalesce(n, 0) > 0 AS drifted
    FROM r FULL JOIN s USING (feed_key)""",
)
def _(spark, d):
    runs = V.runs(spark, d)
    signed = (
        V.table(spark, d, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("feed_key"),
            F.col("o_custkey").cast("string").alias("signature_hash"),
        )
        .agg(F.min(V.ts("o_orderdate")).alias("first_seen_at"))
    )
    return health.feed_health(runs, signed, newest(runs, "started_at"), hours=240)


_LETTERS = """letters AS (SELECT *, sha256(concat_ws('|', lang || '.' || source, 'not_a_feed',
      CAST(1700000000000000 + doc_id * 1000000 AS VARCHAR), message, sha256(text))) AS failure_id
    FROM (SELECT *, 'no feed: ' || text AS message FROM documents))"""


def _letters(spark, d) -> DataFrame:
    docs = V.table(spark, d, "documents")
    return dead_letters.dead_letter(
        docs,
        F.concat("lang", F.lit("."), "source"),
        F.lit("not_a_feed"),
        F.concat(F.lit("no feed: "), "text"),
        F.col("text"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id")),
    )


@query(
    "dead_letters",
    f"""WITH {_LETTERS} SELECT failure_id, lang || '.' || source AS feed_key,
      'not_a_feed' AS error_class, left(message, 2000) AS error_message,
      least(strlen(text), 4096) AS payload_bytes, strlen(text) > 4096 AS sample_payload_truncated,
      make_timestamp(1700000000000000 + doc_id * 1000000) AS occurred_at FROM letters""",
)
def _(spark, d):
    size = F.octet_length("sample_payload").cast("long").alias("payload_bytes")
    return _letters(spark, d).select(
        "failure_id",
        "feed_key",
        "error_class",
        "error_message",
        size,
        "sample_payload_truncated",
        "occurred_at",
    )


@query(
    "unresolved_failures",
    f"""WITH {_LETTERS} SELECT failure_id,
      make_timestamp(1700000000000000 + doc_id * 1000000) AS occurred_at
    FROM letters WHERE lang <> 'en'""",
)
def _(spark, d):
    done = F.when(F.col("feed_key").startswith("en."), F.col("occurred_at"))
    failures = _letters(spark, d).withColumn("resolved_at", done)
    return dead_letters.unresolved_failures(failures).select("failure_id", "occurred_at")


@query(
    "flag_bad_payloads",
    """SELECT 'page' AS kind, page_id AS id, 'html_page' AS reject_reason FROM pages
      WHERE regexp_matches(lower(html), '^\\s*(<!doctype html|<html)')
    UNION ALL SELECT 'page', page_id, NULL FROM pages
      WHERE NOT regexp_matches(lower(html), '^\\s*(<!doctype html|<html)')
    UNION ALL SELECT 'document', doc_id, CASE WHEN text = '' THEN 'empty'
      WHEN regexp_matches(lower(text), '^\\s*(<!doctype html|<html)') THEN 'html_page' END
    FROM documents
    UNION ALL SELECT 'archive', doc_id, CASE WHEN doc_id % 2 = 0 THEN 'not_a_zip' END FROM documents""",
)
def _(spark, d):
    pages, docs = V.table(spark, d, "pages"), V.table(spark, d, "documents")

    def payload(df, kind, key, body):
        return df.select(
            F.lit(kind).alias("kind"), F.col(key).alias("id"), body.cast("binary").alias("content")
        )

    as_feeds = payload(pages, "page", "page_id", F.col("html")).unionByName(
        payload(docs, "document", "doc_id", F.col("text"))
    )
    zipped = F.when(
        F.col("doc_id") % 2 != 0, F.concat(F.unhex(F.lit(feeds.ARCHIVE_MAGIC)), F.col("text").cast("binary"))
    ).otherwise(F.col("text").cast("binary"))
    archives = payload(docs, "archive", "doc_id", zipped)
    return (
        feeds.flag_bad_payloads(as_feeds, "feed")
        .unionByName(feeds.flag_bad_payloads(archives, "archive"))
        .drop("content")
    )


# --- catalog and names ------------------------------------------------------------------


@query("list_routes", f"WITH {V.ROUTES} SELECT * FROM routes")
def _(spark, d):
    return names.list_routes(V.routes(spark, d))


@query(
    "agencies",
    """SELECT CAST(s_suppkey AS VARCHAR) AS agency_id, s_name AS name, 'UTC' AS timezone
    FROM supplier""",
)
def _(spark, d):
    agency = V.table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("agency_id"),
        F.col("s_name").alias("agency_name"),
        F.lit("UTC").alias("agency_timezone"),
    )
    return names.agencies(agency, ("ttc", "Toronto Transit Commission", "America/Toronto"))


_RESOLVED = """norm AS (SELECT *, lower(trim(route_text)) AS q FROM asked),
  distinct_q AS (SELECT DISTINCT q FROM norm WHERE q <> ''),
  named AS (SELECT lower(route_long_name) AS name, coalesce(route_type, 99) AS t,
      route_short_name AS s, route_id AS id FROM routes),
  hits AS (
    SELECT q, 1 AS tier, 0 AS t, route_short_name AS s, route_id AS id
    FROM distinct_q JOIN routes ON lower(route_short_name) = q
    UNION ALL
    SELECT q, 2, t, s, id FROM distinct_q JOIN (
      SELECT DISTINCT unnest(regexp_extract_all(name, '[a-z0-9]+')) AS w, t, s, id FROM named)
      ON w = q
    UNION ALL
    SELECT q, 3, t, s, id FROM distinct_q JOIN named ON contains(name, q)),
  best AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY q ORDER BY tier, t, s, id) = 1),
  resolved AS (SELECT query_id, route_text, CAST(tier AS VARCHAR) AS tier, r.route_id,
      r.route_short_name, r.route_long_name, r.route_type
    FROM norm LEFT JOIN best USING (q) LEFT JOIN routes r ON r.route_id = best.id)"""


@query(
    "resolve_routes",
    f"WITH {V.ROUTES}, {V.ROUTE_QUERIES}, {_RESOLVED} SELECT * FROM resolved",
)
def _(spark, d):
    return names.resolve_routes(V.route_queries(spark, d), V.routes(spark, d))


_LOOSE = (
    _RESOLVED.replace(
        "SELECT q, 3, t, s, id FROM distinct_q JOIN named",
        f"""SELECT q, 3, t, s, id FROM (
        SELECT DISTINCT q, unnest(regexp_extract_all(q, '[a-z0-9]+')) AS w FROM distinct_q) JOIN (
        SELECT DISTINCT unnest(regexp_extract_all(name, '[a-z0-9]+')) AS w, t, s, id FROM named) USING (w)
      WHERE w NOT IN {names.STOP_WORDS}
    UNION ALL
    SELECT q, 4, t, s, id FROM distinct_q JOIN named""",
    ).replace("CAST(tier AS VARCHAR)", "CASE tier WHEN 3 THEN '2b' WHEN 4 THEN '3' ELSE CAST(tier AS VARCHAR) END")
)


@query(
    "resolve_routes_loose",
    f"""WITH {V.ROUTES}, {V.ROUTE_QUERIES.replace("asked AS", "said AS")},
    asked AS (SELECT query_id, CASE query_id % 3 WHEN 0 THEN route_text
      ELSE 'On the ' || route_text || ' bus' END AS route_text FROM said), {_LOOSE} SELECT * FROM resolved""",
)
def _(spark, d):
    spoken = F.concat(F.lit("On the "), "route_text", F.lit(" bus"))
    text = F.when(F.col("query_id") % 3 == 0, F.col("route_text")).otherwise(spoken)
    asked = V.route_queries(spark, d).withColumn("route_text", text)
    return names.resolve_routes(asked, V.routes(spark, d), loose=True)


_EVENT_ROUTES = """routes AS (SELECT DISTINCT event_type AS route_id,
    upper(left(event_type, 2)) AS route_short_name, 'The ' || event_type || ' line' AS route_long_name,
    CAST(length(event_type) % 4 AS INTEGER) AS route_type FROM events),
  asked AS (SELECT p_partkey AS query_id, coalesce(CASE p_partkey % 6 WHEN 5 THEN p_name
      ELSE list_sort((SELECT list(route_id) FROM routes))[1 + p_partkey % 6] END, 'x') AS route_text
    FROM part)"""


@query(
    "vehicles_on_route",
    f"""WITH {V.VP}, {_EVENT_ROUTES}, {_RESOLVED},
    live AS (SELECT * FROM vp WHERE received_at > (SELECT max(ts) - INTERVAL 25 DAY FROM events)
      QUALIFY row_number() OVER (PARTITION BY route_id, vehicle_id ORDER BY received_at DESC) = 1),
    fleet AS (SELECT route_id, count(*) AS n, min(vehicle_id) AS v FROM live GROUP BY 1)
    SELECT query_id, route_text, r.route_id IS NOT NULL AS matched, tier, r.route_id,
      route_short_name, route_long_name, route_type,
      CASE WHEN r.route_id IS NOT NULL THEN coalesce(n, 0) END AS vehicle_count,
      v AS first_vehicle, CASE WHEN r.route_id IS NOT NULL THEN coalesce(n > 50, false) END AS truncated
    FROM resolved r LEFT JOIN fleet f ON f.route_id = r.route_id""",
)
def _(spark, d):
    vp = V.vehicle_positions(spark, d)
    kind = F.col("event_type")
    routes = (
        V.table(spark, d, "events")
        .select(
            kind.alias("route_id"),
            F.upper(F.left(kind, F.lit(2))).alias("route_short_name"),
            F.concat(F.lit("The "), kind, F.lit(" line")).alias("route_long_name"),
            (F.length(kind) % 4).alias("route_type"),
        )
        .distinct()
    )
    all_ids = routes.agg(F.array_sort(F.collect_list("route_id"))).scalar()
    k = F.col("p_partkey")
    text = F.when(k % 6 == 5, F.col("p_name")).otherwise(F.get("ids", k % 6))
    asked = (
        V.table(spark, d, "part")
        .withColumn("ids", all_ids)
        .select(k.alias("query_id"), F.coalesce(text, F.lit("x")).alias("route_text"))
    )
    answer = names.vehicles_on_route(asked, routes, vp, newest(vp), limit=50, minutes=25 * 1440)
    return answer.withColumn(
        "first_vehicle", F.get("vehicles", F.lit(0))["vehicle_id"]
    ).drop("vehicles")


_GRAMS = """{0}_grams AS (SELECT text, list_distinct(flatten(list_transform(
      regexp_extract_all(lower(text), '[a-z0-9]+'),
      lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3))))) AS g
    FROM (SELECT DISTINCT {1} AS text FROM part))"""


@query(
    "fuzzy_names",
    f"""WITH {_GRAMS.format("q", "substr(p_name, 2, 8) || left(p_type, 2)")},
    {_GRAMS.format("n", "p_name")}, pairs AS (
      SELECT q.text AS query, n.text AS name, len(list_intersect(q.g, n.g)) AS shared,
        len(q.g) AS nq, len(n.g) AS nn FROM q_grams q, n_grams n)
    SELECT query, name, shared / (nq + nn - shared) AS similarity FROM pairs
    WHERE shared / (nq + nn - shared) >= 0.3""",
)
def _(spark, d):
    part = V.table(spark, d, "part")
    said = F.concat(F.substring("p_name", 2, 8), F.left("p_type", F.lit(2)))
    return names.fuzzy_names(part.select(said.alias("query")), part.select(F.col("p_name").alias("name")))


# --- places -----------------------------------------------------------------------------

def to_mm(df: DataFrame) -> DataFrame:
    return df.withColumn("distance_m", F.round("distance_m", 3))


_STOP = "stop_id, stop_code, stop_name, latitude, longitude"


@query(
    "nearest_stops",
    f"""WITH {V.STOPS} SELECT {_STOP},
      round({V.haversine_sql('43.6532', '-79.3832', 'latitude', 'longitude')}, 3) AS distance_m
    FROM stops ORDER BY distance_m, stop_id LIMIT 10""",
)
def _(spark, d):
    return to_mm(geo_join.nearest_stops(V.stops(spark, d), 43.6532, -79.3832))


# The WGS 84 distance from one point: the great circle between reduced latitudes, corrected.
_WGS84 = """reduced AS (SELECT *, atan((1 - 1 / 298.257223563) * tan(radians(43.6532))) AS b1,
    atan((1 - 1 / 298.257223563) * tan(radians(latitude))) AS b2 FROM stops),
  angles AS (SELECT *, (b1 + b2) / 2 AS p, (b2 - b1) / 2 AS q, 2 * asin(sqrt(pow(sin((b2 - b1) / 2), 2)
    + cos(b1) * cos(b2) * pow(sin(radians(longitude + 79.3832) / 2), 2))) AS w FROM reduced),
  measured AS (SELECT *, CASE WHEN w = 0 THEN 0 ELSE 6378137.0 * (w - 1 / 298.257223563 / 2 * (
      (w - sin(w)) * pow(sin(p) * cos(q) / cos(w / 2), 2)
      + (w + sin(w)) * pow(cos(p) * sin(q) / sin(w / 2), 2))) END AS m FROM angles)"""


@query(
    "nearest_stops_ellipsoidal",
    f"""WITH {V.STOPS}, {_WGS84} SELECT {_STOP}, round(m, 3) AS distance_m FROM measured
    ORDER BY {V.haversine_sql('43.6532', '-79.3832', 'latitude', 'longitude')}, stop_id LIMIT 100""",
)
def _(spark, d):
    near = geo_join.nearest_stops(V.stops(spark, d), 43.6532, -79.3832, limit=100, ellipsoidal=True)
    return to_mm(near)


_PAIRS = f"""pairs AS (SELECT point_id, {_STOP.replace(', lat', ', s.lat').replace(', lon', ', s.lon')},
    {V.haversine_sql('p.latitude', 'p.longitude', 's.latitude', 's.longitude')} AS distance_m
  FROM points p, stops s)"""


@query(
    "nearest_stops_join",
    f"""WITH {V.STOPS}, {V.POINTS}, {_PAIRS}, ranked AS (SELECT *, CAST(row_number() OVER (
        PARTITION BY point_id ORDER BY distance_m, stop_id) AS INTEGER) AS rank FROM pairs)
    SELECT * REPLACE (round(distance_m, 3) AS distance_m) FROM ranked WHERE rank <= 5""",
)
def _(spark, d):
    return to_mm(geo_join.nearest_stops_join(V.points(spark, d), V.stops(spark, d), 5))


@query(
    "stops_within",
    f"WITH {V.STOPS}, {V.POINTS}, {_PAIRS} SELECT * REPLACE (round(distance_m, 3) AS distance_m) "
    "FROM pairs WHERE distance_m <= 1500",
)
def _(spark, d):
    return to_mm(geo_join.stops_within(V.points(spark, d), V.stops(spark, d), 1500))


# --- checks of keys and values ----------------------------------------------------------


@query(
    "fk_violations",
    """SELECT l_orderkey, count(*) AS n_rows FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    GROUP BY 1""",
)
def _(spark, d):
    finished = V.table(spark, d, "orders").filter("o_orderstatus = 'F'")
    line = V.table(spark, d, "lineitem")
    return quality.fk_violations(line, finished, ["l_orderkey"], ["o_orderkey"])


@query(
    "key_violations",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY ALL HAVING count(*) > 1""",
)
def _(spark, d):
    return quality.key_violations(V.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "null_violations",
    """WITH t AS (SELECT CASE WHEN user_id % 7 <> 0 THEN user_id END AS vehicle_id,
        CASE WHEN event_type <> 'click' THEN event_type ELSE '' END AS route_id, ts FROM events)
    SELECT 'vehicle_id' AS column_name, count(*) FILTER (vehicle_id IS NULL) AS n_rows FROM t
    UNION ALL SELECT 'route_id', count(*) FILTER (route_id = '') FROM t""",
)
def _(spark, d):
    e = V.table(spark, d, "events").select(
        F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("vehicle_id"),
        F.when(F.col("event_type") != "click", F.col("event_type")).otherwise("").alias("route_id"),
        "ts",
    )
    return quality.null_violations(e, ["vehicle_id", "route_id", "ts"])


@query(
    "dq_scorecard",
    """WITH t AS (SELECT count(*) AS n, count(*) FILTER (value < 100) AS a,
        count(*) FILTER (user_id % 7 <> 0) AS b,
        count(*) FILTER (ts > (SELECT max(ts) - INTERVAL 7 DAY FROM events)) AS c,
        count(*) FILTER (event_type <> 'error' OR value < 50) AS e,
        count(DISTINCT (user_id, event_type)) AS u FROM events),
      card AS (SELECT 'validity' AS dimension, 'value' AS rule, n AS n_rows, a AS n_passed FROM t
        UNION ALL SELECT 'completeness', 'vehicle', n, b FROM t
        UNION ALL SELECT 'timeliness', 'last_week', n, c FROM t
        UNION ALL SELECT 'consistency', 'errors_are_small', n, e FROM t
        UNION ALL SELECT 'uniqueness', 'user_type', n, u FROM t)
    SELECT *, n_passed / n_rows AS score FROM card""",
)
def _(spark, d):
    e = V.table(spark, d, "events").withColumn("at", V.ts("ts"))
    rules = {
        ("validity", "value"): F.col("value") < 100,
        ("completeness", "vehicle"): F.when(F.col("user_id") % 7 != 0, F.col("user_id")).isNotNull(),
        ("timeliness", "last_week"): F.col("at") > M.minus(newest(e, "at"), days=7),
        ("consistency", "errors_are_small"): (F.col("event_type") != "error") | (F.col("value") < 50),
    }
    return quality.dq_scorecard(e, rules, {"user_type": ["user_id", "event_type"]})


# --- merges -----------------------------------------------------------------------------

_LINE_KEYS = ["l_orderkey", "l_linenumber"]


@query(
    "append_new",
    """WITH current AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem
        WHERE l_returnflag = 'R'),
      batch AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_partkey, l_suppkey) = 1)
    SELECT * FROM batch b WHERE NOT EXISTS (SELECT 1 FROM current c
      WHERE c.l_orderkey = b.l_orderkey AND c.l_linenumber = b.l_linenumber)""",
)
def _(spark, d):
    """All lines as a batch, for a table that has the returned ones already."""
    line = V.table(spark, d, "lineitem")
    current = line.filter("l_returnflag = 'R'").select(*_LINE_KEYS).distinct()
    batch = line.select(*_LINE_KEYS, "l_partkey", "l_suppkey")
    order = [F.col("l_partkey"), F.col("l_suppkey")]
    return merges.append_new(current, batch, _LINE_KEYS, order)


@query(
    "upsert_alerts",
    """WITH polls AS (SELECT conv_id AS alert_id, turn AS first_seen, turn AS last_seen,
        text AS header_text FROM conversations)
    SELECT alert_id, min(first_seen) AS first_seen, max(last_seen) AS last_seen,
      arg_max(header_text, last_seen) AS header_text FROM polls GROUP BY 1""",
)
def _(spark, d):
    polls = V.table(spark, d, "conversations").select(
        F.col("conv_id").alias("alert_id"),
        F.col("turn").alias("first_seen"),
        F.col("turn").alias("last_seen"),
        F.col("text").alias("header_text"),
    )
    merged = polls.limit(0)
    # The earlier polls come last: they must not undo the later ones.
    for part in (polls.filter("last_seen >= 3"), polls.filter("last_seen < 3")):
        merged = merges.upsert_keep_first(
            merged, part, ["alert_id"], keep=["first_seen"], order=["last_seen"], newer="last_seen"
        )
    return merged


@query(
    "upsert_signatures",
    """SELECT o_orderpriority AS feed_key, CAST(o_custkey % 20 AS VARCHAR) AS signature_hash,
      min(CAST(o_orderdate AS TIMESTAMP)) AS first_seen_at,
      max(CAST(o_orderdate AS TIMESTAMP)) AS last_seen_at, count(*) AS sample_count
    FROM orders GROUP BY 1, 2""",
)
def _(spark, d):
    o = V.table(spark, d, "orders")
    seen = o.select(
        F.col("o_orderpriority").alias("feed_key"),
        (F.col("o_custkey") % 20).cast("string").alias("signature_hash"),
        F.array(F.lit("id"), F.lit("vehicle")).alias("populated_fields"),
        V.ts("o_orderdate").alias("first_seen_at"),
        V.ts("o_orderdate").alias("last_seen_at"),
        F.lit(1).cast("long").alias("sample_count"),
        "o_orderstatus",
    )
    old = seen.filter("o_orderstatus = 'F'").drop("o_orderstatus")
    new = seen.filter("o_orderstatus <> 'F'").drop("o_orderstatus")
    current = merges.upsert_signature(old.limit(0), old)
    return merges.upsert_signature(current, new).drop("populated_fields")


@query(
    "expired_partitions",
    """WITH n AS (SELECT DISTINCT CASE o_orderkey % 5
        WHEN 0 THEN 'trip_updates_p' || strftime(o_orderdate, '%Y%m%d')
        WHEN 1 THEN 'trip_updates_p' || strftime(o_orderdate, '%Y') || '1341'
        WHEN 2 THEN 'trip_updates_backup_' || o_custkey
        ELSE 'trip_updates_old_p' || strftime(o_orderdate, '%Y%m%d') END AS name FROM orders),
      p AS (SELECT name, try_strptime(name, 'trip_updates_p%Y%m%d') AS t FROM n)
    SELECT name, strftime(t, '%Y-%m-%d') AS day FROM p
    WHERE t < DATE '1999-06-15' - 3""",
)
def _(spark, d):
    o, k = V.table(spark, d, "orders"), F.col("o_orderkey")
    stamp = F.date_format("o_orderdate", "yyyyMMdd")
    name = (
        F.when(k % 5 == 0, F.concat(F.lit("trip_updates_p"), stamp))
        .when(k % 5 == 1, F.concat(F.lit("trip_updates_p"), F.date_format("o_orderdate", "yyyy"), F.lit("1341")))
        .when(k % 5 == 2, F.concat(F.lit("trip_updates_backup_"), "o_custkey"))
        .otherwise(F.concat(F.lit("trip_updates_old_p"), stamp))
    )
    return retention.expired_partitions(o.select(name.alias("name")).distinct(), "trip_updates", "1999-06-15")


# --- static tables ----------------------------------------------------------------------


@query(
    "type_stops",
    """SELECT CAST(c_custkey AS VARCHAR) AS stop_id, c_mktsegment AS stop_code, c_name AS stop_name,
      NULL::VARCHAR AS zone_id,
      CASE WHEN c_custkey % 17 <> 0 THEN c_acctbal / 100 END AS latitude,
      CASE WHEN c_custkey % 19 <> 0 THEN c_acctbal / 50 END AS longitude,
      CASE c_custkey % 3 WHEN 0 THEN 2 ELSE NULL END AS location_type, '2026-04-14' AS snapshot_date
    FROM customer""",
)
def _(spark, d):
    k = F.col("c_custkey")

    def number(c, n):
        return F.when(k % n != 0, c.cast("string")).otherwise("  ")

    raw = V.table(spark, d, "customer").select(
        F.concat(F.lit(" "), k, F.lit("\t")).alias("stop_id"),
        F.concat("c_mktsegment", F.lit(" ")).alias("stop_code"),
        F.col("c_name").alias("stop_name"),
        F.lit(None).cast("string").alias("stop_desc"),
        number(F.col("c_acctbal") / 100, 17).alias("stop_lat"),
        number(F.col("c_acctbal") / 50, 19).alias("stop_lon"),
        F.lit(" ").alias("zone_id"),
        F.when(k % 3 == 0, " 2 ").when(k % 3 == 1, "two").otherwise("").alias("location_type"),
        F.lit("").alias("parent_station"),
    )
    typed = static_tables.type_stops(raw, "2026-04-14")
    return typed.drop("stop_desc", "parent_station")


_CLOCK = """line AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey % 30 AS h,
    l_suppkey % 60 AS m, l_partkey % 60 AS s FROM lineitem)"""


@query(
    "type_stop_times",
    f"""WITH {_CLOCK} SELECT CAST(l_orderkey AS VARCHAR) AS trip_id,
      CAST(l_linenumber AS INTEGER) AS stop_sequence, CAST(l_suppkey AS VARCHAR) AS stop_id,
      CASE WHEN l_suppkey % 7 <> 0 THEN CAST(h * 3600 + m * 60 + s AS INTEGER) END AS arrival_s,
      CAST(h * 3600 + m * 60 + s AS INTEGER) AS departure_s,
      CASE WHEN l_suppkey % 7 <> 0 THEN CAST((h * 3600 + m * 60 + s) // 86400 AS INTEGER) END AS arrival_day,
      CASE WHEN l_suppkey % 2 = 0 THEN 1 END AS pickup_type,
      CAST(l_linenumber * 1.5 AS DOUBLE) AS shape_dist_traveled FROM line""",
)
def _(spark, d):
    line = V.table(spark, d, "lineitem")

    def two(c):
        return F.lpad(c.cast("string"), 2, "0")

    parts = [F.col("l_partkey") % 30, F.col("l_suppkey") % 60, F.col("l_partkey") % 60]
    clock = F.concat_ws(":", *[two(c) for c in parts])
    raw = line.select(
        F.concat(F.lit(" "), "l_orderkey").alias("trip_id"),
        F.concat(F.lit(" "), "l_linenumber", F.lit(" ")).alias("stop_sequence"),
        F.col("l_suppkey").cast("string").alias("stop_id"),
        F.when(F.col("l_suppkey") % 7 != 0, clock).otherwise("").alias("arrival_time"),
        clock.alias("departure_time"),
        F.when(F.col("l_suppkey") % 2 == 0, "1").otherwise("").alias("pickup_type"),
        F.lit(None).cast("string").alias("drop_off_type"),
        (F.col("l_linenumber") * 1.5).cast("string").alias("shape_dist_traveled"),
    )
    typed = static_tables.type_stop_times(raw, "2026-04-14")
    # The interval itself has no counterpart in every client; its whole days do.
    days = F.extract(F.lit("DAY"), "arrival_time").cast("int").alias("arrival_day")
    return typed.select(
        "trip_id", "stop_sequence", "stop_id", "arrival_s", "departure_s", days,
        "pickup_type", "shape_dist_traveled",
    )


_CALENDAR = """calendar AS (SELECT CAST(c_custkey AS VARCHAR) AS service_id,
    DATE '2024-01-01' + CAST(c_custkey % 20 AS INTEGER) AS start_date,
    DATE '2024-01-10' + CAST(c_custkey % 45 AS INTEGER) AS end_date, c_custkey AS k FROM customer)"""


def _raw_calendar(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    start = F.date_add(F.lit("2024-01-01").cast("date"), (k % 20).cast("int"))
    end = F.date_add(F.lit("2024-01-10").cast("date"), (k % 45).cast("int"))
    days = [
        F.when(F.floor(k / 2**i) % 2 == 1, " 1").otherwise("0").alias(day)
        for i, day in enumerate(static_tables.S.WEEKDAYS)
    ]
    return V.table(spark, d, "customer").select(
        k.cast("string").alias("service_id"),
        *days,
        F.date_format(start, "yyyyMMdd").alias("start_date"),
        F.date_format(end, "yyyyMMdd").alias("end_date"),
    )


@query(
    "type_calendar",
    f"""WITH {_CALENDAR} SELECT service_id, strftime(start_date, '%Y-%m-%d') AS start_date,
      strftime(end_date, '%Y-%m-%d') AS end_date,
      {', '.join(f"k // {2**i} % 2 = 1 AS {day}" for i, day in enumerate(static_tables.S.WEEKDAYS))},
      '2026-04-14' AS snapshot_date FROM calendar""",
)
def _(spark, d):
    return static_tables.type_calendar(_raw_calendar(spark, d), "2026-04-14")


_EXCEPTIONS = """exceptions AS (SELECT CAST(o_custkey AS VARCHAR) AS service_id,
    DATE '2024-01-01' + CAST(o_orderkey % 40 AS INTEGER) AS exception_date,
    min(CAST(1 + o_orderkey // 40 % 2 AS INTEGER)) AS exception_type FROM orders GROUP BY 1, 2)"""


@query(
    "active_services",
    f"""WITH {_CALENDAR}, {_EXCEPTIONS},
      days AS (SELECT CAST(unnest(generate_series(DATE '2024-01-05', DATE '2024-02-10',
        INTERVAL 1 DAY)) AS DATE) AS dd),
      regular AS (SELECT service_id, dd FROM calendar, days
        WHERE dd BETWEEN start_date AND end_date AND (k >> (isodow(dd) - 1)) % 2 = 1),
      active AS (SELECT * FROM regular r WHERE NOT EXISTS (SELECT 1 FROM exceptions e
          WHERE e.service_id = r.service_id AND e.exception_date = r.dd AND exception_type = 2)
        UNION SELECT service_id, exception_date FROM exceptions
          WHERE exception_type = 1 AND exception_date BETWEEN '2024-01-05' AND '2024-02-10')
    SELECT service_id, strftime(dd, '%Y-%m-%d') AS service_date FROM active""",
)
def _(spark, d):
    calendar = static_tables.type_calendar(_raw_calendar(spark, d), "2026-04-14")
    k = F.col("o_orderkey")
    date = F.date_add(F.lit("2024-01-01").cast("date"), (k % 40).cast("int"))
    exceptions = (
        V.table(spark, d, "orders")
        .groupBy(F.col("o_custkey").cast("string").alias("service_id"), date.alias("exception_date"))
        .agg(F.min(F.lit(1) + F.expr("o_orderkey div 40") % 2).cast("int").alias("exception_type"))
    )
    return services.active_services(calendar, exceptions, "2024-01-05", "2024-02-10")


# --- feed rows --------------------------------------------------------------------------


@query(
    "vehicle_position_rows",
    """SELECT ts AS received_at,
      CASE WHEN event_id % 6 <> 0 THEN date_trunc('second', ts) ELSE ts END AS feed_timestamp,
      'ttc' AS agency_id, CASE WHEN event_id % 11 <> 0 THEN CAST(user_id AS VARCHAR) END AS vehicle_id,
      CASE WHEN event_id % 9 <> 0 AND event_id % 5 <> 0 THEN CAST(event_id // 3 AS VARCHAR) END AS trip_id,
      CASE WHEN event_id % 9 <> 0 THEN event_type END AS route_id,
      CASE WHEN event_id % 9 <> 0 THEN CAST(user_id % 2 AS INTEGER) END AS direction_id,
      CAST(CAST(43.5 + CAST(user_id * 37 % 1000 AS DOUBLE) / 2000 AS FLOAT) AS DOUBLE) AS latitude,
      CAST(CAST(-79.6 + CAST(user_id * 91 % 1000 AS DOUBLE) / 2000 AS FLOAT) AS DOUBLE) AS longitude,
      CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 360 AS FLOAT) END AS bearing,
      CAST(value AS FLOAT) AS speed_mps, value AS odometer_m,
      CAST(event_id % 3 AS INTEGER) AS current_status,
      CAST(event_id % 7 AS INTEGER) AS current_stop_sequence, CAST(user_id % 5 AS VARCHAR) AS stop_id,
      CASE WHEN event_id % 4 <> 0 THEN 5 END AS occupancy_status,
      sha256(CAST(event_id AS VARCHAR)) AS raw_payload_hash
    FROM events WHERE event_type <> 'error'""",
)
def _(spark, d):
    rows = feed_rows.vehicle_position_rows(V.position_messages(spark, d))
    return rows.drop("congestion_level")


@query(
    "trip_update_rows",
    """WITH trips AS (SELECT event_id // 3 AS trip, max(ts) AS received_at FROM events GROUP BY 1)
    SELECT received_at, date_trunc('second', received_at) AS feed_timestamp, 'ttc' AS agency_id,
      CAST(trip AS VARCHAR) AS trip_id, CASE WHEN trip % 3 <> 0 THEN 'R1' END AS route_id,
      CAST(trip % 2 AS INTEGER) AS direction_id,
      CASE WHEN trip % 5 <> 0 THEN strftime(received_at, '%Y-%m-%d') END AS start_date,
      3 AS schedule_relationship, CAST(event_id % 7 AS INTEGER) AS stop_sequence,
      CAST(user_id % 5 AS VARCHAR) AS stop_id,
      CASE WHEN event_id % 4 <> 0 THEN date_trunc('second', ts) END AS arrival_time,
      CASE WHEN event_id % 4 <> 0 THEN CAST(event_id % 90 AS INTEGER) END AS arrival_delay_s,
      date_trunc('second', ts) + INTERVAL 20 SECOND AS departure_time,
      sha256(CAST(trip AS VARCHAR)) AS raw_payload_hash
    FROM events JOIN trips ON trip = event_id // 3""",
)
def _(spark, d):
    return feed_rows.trip_update_rows(V.trip_messages(spark, d)).drop("departure_delay_s")


_ALERTS = """alerts AS (SELECT CAST(conv_id AS VARCHAR) AS alert_id, 'ttc' AS agency_id,
    make_timestamp((1700000000 + conv_id * 1000 + turn * 60) * 1000000) AS seen_at,
    text AS header_text, 'r' || turn AS r1, 'r' || conv_id % 3 AS r2, 's' || turn AS s1, turn
  FROM conversations)"""


@query(
    "service_alert_rows",
    f"""WITH {_ALERTS} SELECT alert_id, agency_id, seen_at AS first_seen_at, seen_at AS last_seen_at,
      seen_at AS feed_timestamp, 9 AS cause, 4 AS effect, header_text,
      array_to_string(list_sort(list_distinct([r1, r2])), ',') AS affected_routes, s1 AS affected_stops,
      0 AS n_trips, CASE WHEN turn % 2 = 0 THEN seen_at END AS active_period_start FROM alerts""",
)
def _(spark, d):
    rows = feed_rows.service_alert_rows(V.alert_messages(spark, d))
    return rows.select(
        "alert_id",
        "agency_id",
        "first_seen_at",
        "last_seen_at",
        "feed_timestamp",
        "cause",
        "effect",
        "header_text",
        F.array_join("affected_routes", ",").alias("affected_routes"),
        F.array_join("affected_stops", ",").alias("affected_stops"),
        F.size("affected_trips").alias("n_trips"),
        "active_period_start",
    )


@query(
    "merge_alert_polls",
    f"""WITH {_ALERTS} SELECT agency_id, alert_id, min(seen_at) AS first_seen_at,
      max(seen_at) AS last_seen_at, arg_max(header_text, turn) AS header_text,
      arg_max(s1, turn) AS affected_stops FROM alerts GROUP BY 1, 2""",
)
def _(spark, d):
    rows = feed_rows.service_alert_rows(V.alert_messages(spark, d), keep_position=True)
    current = rows.drop("position").limit(0)
    merged = merges.upsert_keep_first(
        current, rows, ["agency_id", "alert_id"], order=["last_seen_at", "position"]
    )
    return merged.select(
        "agency_id", "alert_id", "first_seen_at", "last_seen_at", "header_text",
        F.array_join("affected_stops", ",").alias("affected_stops"),
    )


@query(
    "field_signature",
    """WITH p AS (SELECT event_id // 5 AS poll, unnest(list_concat(
        ['id', 'vehicle', 'vehicle.stop_id'],
        CASE WHEN event_id % 3 <> 0 THEN ['vehicle.position', 'vehicle.position.latitude'] ELSE [] END,
        CASE WHEN event_id % 11 = 0 THEN ['vehicle.extra_field'] ELSE [] END,
        CASE WHEN event_id % 7 = 0 THEN ['vehicle.carriages', 'vehicle.carriages.label'] ELSE [] END
      )) AS path FROM events)
    SELECT poll, sha256(string_agg(DISTINCT path, chr(10) ORDER BY path)) AS signature_hash,
      count(DISTINCT path) AS n_fields FROM p GROUP BY 1""",
)
def _(spark, d):
    i = F.col("event_id")
    none = F.lit(None)
    vehicle = F.struct(
        (F.col("user_id") % 5).cast("string").alias("stop_id"),
        F.when(i % 3 != 0, F.struct(F.col("value").alias("latitude"))).alias("position"),
        F.when(i % 11 == 0, F.lit(1)).alias("extra_field"),
        F.when(i % 7 == 0, F.array(F.struct(F.lit("a").alias("label"))))
        .otherwise(F.array().cast("array<struct<label:string>>"))
        .alias("carriages"),
        none.cast("string").alias("never_set"),
    )
    polls = (
        V.table(spark, d, "events")
        .groupBy(F.expr("event_id div 5").alias("poll"))
        .agg(F.collect_list(F.struct(i.cast("string").alias("id"), vehicle.alias("vehicle"))).alias("entity"))
        .select("poll", F.to_json(F.struct("entity"), {"ignoreNullFields": "false"}).alias("content"))
    )
    signed = signatures.field_signature(polls, by=("poll",))
    return signed.select(
        "poll", "signature_hash", F.size("populated_fields").cast("long").alias("n_fields")
    )


@query(
    "words_and_numbers",
    """SELECT doc_id, len(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS n_words,
      sha256(text) AS digest, CAST(n_chars AS INTEGER) AS number FROM documents""",
)
def _(spark, d):
    docs = V.table(spark, d, "documents")
    return docs.select(
        "doc_id",
        F.size(X.words(F.col("text"))).cast("long").alias("n_words"),
        X.sha256(F.col("text")).alias("digest"),
        X.int_or_null(F.concat(F.lit(" "), "n_chars")).alias("number"),
    )


# --- delay ------------------------------------------------------------------------------

_ZONE = "America/Toronto"


def _at(day: str, seconds: str) -> str:
    """SQL for local noon minus twelve hours plus seconds, as a UTC time."""
    return (
        f"(((CAST({day} AS TIMESTAMP) + INTERVAL 12 HOUR) AT TIME ZONE '{_ZONE}') AT TIME ZONE 'UTC'"
        f" - INTERVAL 12 HOUR + to_seconds({seconds}))"
    )


@query(
    "scheduled_at",
    f"""SELECT o_orderkey, {_at("CAST(o_orderdate AS DATE)", "o_custkey * 61 % 100000")} AS scheduled_at
    FROM orders""",
)
def _(spark, d):
    o = V.table(spark, d, "orders")
    at = M.scheduled_at(F.to_date("o_orderdate"), F.col("o_custkey") * 61 % 100_000, F.lit(_ZONE))
    return o.select("o_orderkey", at.alias("scheduled_at"))


_PREDICTED = f"""timed AS (SELECT tu.*, arrival_s FROM tu JOIN st USING (trip_id, stop_sequence)),
  cands AS (SELECT *, unnest([-1, 0, 1]) AS off FROM timed),
  inferred AS (SELECT * EXCLUDE (off), CAST(arrival_time AS DATE) + off AS day FROM cands
    QUALIFY row_number() OVER (PARTITION BY trip_id, stop_sequence, arrival_time ORDER BY
      abs(epoch(date_trunc('second', arrival_time))
        - epoch({_at("CAST(arrival_time AS DATE) + off", "arrival_s")})), off) = 1),
  dated AS (SELECT * EXCLUDE (start_date, day), coalesce(start_date, day) AS start_date,
    start_date IS NULL AS day_inferred FROM inferred),
  predicted AS (SELECT *, {_at("start_date", "arrival_s")} AS scheduled_at,
    CAST(epoch(date_trunc('second', arrival_time)) - epoch({_at("start_date", "arrival_s")}) AS INTEGER)
      AS delay_s FROM dated)"""


@query(
    "schedule_delay",
    f"""WITH {V.TU}, {V.STOP_TIMES}, {_PREDICTED}
    SELECT strftime(start_date, '%Y-%m-%d') AS start_date, trip_id, stop_sequence, route_id, stop_id,
      scheduled_at, arrival_time AS arrival_at, delay_s, day_inferred, received_at FROM predicted
    QUALIFY row_number() OVER (PARTITION BY start_date, trip_id, stop_sequence
      ORDER BY received_at DESC) = 1""",
)
def _(spark, d):
    return delay.schedule_delay(V.trip_updates(spark, d), V.stop_times(spark, d), _ZONE)


_SEEN = f"""vps AS (SELECT vp.*, arrival_s FROM vp JOIN st ON st.trip_id = vp.trip_id
    AND st.stop_sequence = vp.current_stop_sequence),
  vcands AS (SELECT *, unnest([-1, 0, 1]) AS off FROM vps),
  vdated AS (SELECT *, CAST(received_at AS DATE) + off AS start_date FROM vcands
    QUALIFY row_number() OVER (PARTITION BY raw_payload_hash ORDER BY
      abs(epoch(date_trunc('second', received_at))
        - epoch({_at("CAST(received_at AS DATE) + off", "arrival_s")})), off) = 1),
  visits AS (SELECT DISTINCT start_date, trip_id, stop_sequence FROM predicted),
  ends AS (SELECT v.*,
      min(received_at) FILTER (current_stop_sequence = stop_sequence AND current_status = 1) AS stopped,
      min(received_at) FILTER (current_stop_sequence > stop_sequence) AS passed,
      max(received_at) AS vehicle_last_at
    FROM visits v LEFT JOIN vdated p ON p.trip_id = v.trip_id AND p.start_date = v.start_date
    GROUP BY ALL),
  finals AS (SELECT start_date, trip_id, stop_sequence, least(stopped, passed) AS finalized_at,
    CASE WHEN stopped <= coalesce(passed, stopped) THEN 'stopped' WHEN passed IS NOT NULL THEN 'passed' END
      AS evidence, vehicle_last_at FROM ends)"""


@query(
    "finalize_times",
    f"""WITH {V.TU}, {V.VP}, {V.STOP_TIMES}, {_PREDICTED}, {_SEEN}
    SELECT * EXCLUDE (start_date), strftime(start_date, '%Y-%m-%d') AS start_date FROM finals""",
)
def _(spark, d):
    schedule = V.stop_times(spark, d)
    predicted = delay.schedule_delay(V.trip_updates(spark, d), schedule, _ZONE, newest_only=False)
    seen = delay.sightings(V.vehicle_positions(spark, d), schedule, _ZONE)
    return delay.finalize_times(predicted, seen)


@query(
    "stop_delays",
    f"""WITH {V.TU}, {V.VP}, {V.STOP_TIMES}, {_PREDICTED}, {_SEEN},
    last AS (SELECT p.*, finalized_at, vehicle_last_at FROM predicted p
      JOIN finals f ON f.start_date = p.start_date AND f.trip_id = p.trip_id
        AND f.stop_sequence = p.stop_sequence
      WHERE finalized_at IS NULL OR received_at <= finalized_at
      QUALIFY row_number() OVER (PARTITION BY p.start_date, p.trip_id, p.stop_sequence
        ORDER BY received_at DESC) = 1),
    heard AS (SELECT *, max(greatest(received_at, coalesce(vehicle_last_at, received_at)))
      OVER (PARTITION BY start_date, trip_id) AS h FROM last)
    SELECT strftime(start_date, '%Y-%m-%d') AS start_date, trip_id, stop_sequence, route_id, stop_id,
      scheduled_at, arrival_time AS arrival_at, delay_s,
      CASE WHEN finalized_at IS NOT NULL THEN 'final'
        WHEN h < (SELECT max(ts) - INTERVAL 7 DAY FROM events) THEN 'abandoned' ELSE 'predicted' END AS status,
      coalesce(finalized_at, received_at) AS updated_at FROM heard""",
)
def _(spark, d):
    vp = V.vehicle_positions(spark, d)
    return delay.stop_delays(
        V.trip_updates(spark, d), vp, V.stop_times(spark, d), _ZONE, newest(vp),
        sweep_minutes=7 * 1440,
    )


@query(
    "delay_reliability",
    f"""WITH v AS (SELECT o_orderpriority AS route_id, strftime(o_orderdate, '%Y-%m') || '-01' AS day,
        CAST(extract(hour FROM (CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey * 37 % 86400))
          AT TIME ZONE 'UTC' AT TIME ZONE '{_ZONE}') AS INTEGER) AS hour,
        CAST(o_custkey % 900 - 120 AS INTEGER) AS delay_s FROM orders WHERE o_orderstatus <> 'P')
    SELECT route_id, day, hour, count(*) AS n_visits, round(avg(delay_s), 3) AS avg_delay_s,
      round(quantile_cont(delay_s, 0.5), 3) AS median_delay_s,
      round(quantile_cont(delay_s, 0.9), 3) AS p90_delay_s,
      round(count(*) FILTER (delay_s BETWEEN -60 AND 300) / count(*), 6) AS on_time_share
    FROM v GROUP BY ALL""",
)
def _(spark, d):
    o = V.table(spark, d, "orders")
    at = F.timestamp_seconds(F.unix_seconds(V.ts("o_orderdate")) + F.col("o_orderkey") * 37 % 86_400)
    delays = o.select(
        F.col("o_orderpriority").alias("route_id"),
        F.trunc("o_orderdate", "month").alias("start_date"),
        at.alias("scheduled_at"),
        (F.col("o_custkey") % 900 - 120).cast("int").alias("delay_s"),
        F.when(F.col("o_orderstatus") == "P", "predicted").otherwise("final").alias("status"),
    )
    shares = delay.delay_reliability(delays, zone=_ZONE)
    for c in ("avg_delay_s", "median_delay_s", "p90_delay_s"):
        shares = shares.withColumn(c, F.round(c, 3))
    return shares.withColumn("on_time_share", F.round("on_time_share", 6))
