"""The driver's tables read as transit tables, once as DataFrames and once as SQL.

Each view exists in both forms with the same rows.  They only rename, cast and derive
columns of whole tables; no rows are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AGENCY = "ttc"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def ts(c: str) -> Column:
    return F.col(c).cast("timestamp")


def plain(df: DataFrame) -> DataFrame:
    """Instants without zone and dates as text, as both engines show them alike."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "timestamp":
            c = c.cast("timestamp_ntz")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind == "smallint":
            c = c.cast("int")
        out.append(c.alias(name))
    return df.select(*out)


# --- vehicle positions and trip updates: events --------------------------------------


def vehicle_positions(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_positions_of(table(spark, d, "events"))


def vehicle_positions_of(e: DataFrame) -> DataFrame:
    u = F.col("user_id")
    return e.select(
        ts("ts").alias("received_at"),
        ts("ts").alias("feed_timestamp"),
        F.lit(AGENCY).alias("agency_id"),
        u.cast("string").alias("vehicle_id"),
        F.expr("event_id div 3").cast("string").alias("trip_id"),
        F.col("event_type").alias("route_id"),
        (u % 2).cast("int").alias("direction_id"),
        (F.lit(43.5) + (u * 37 % 1000) / 2000).alias("latitude"),
        (F.lit(-79.6) + (u * 91 % 1000) / 2000).alias("longitude"),
        (F.col("event_id") % 360).cast("float").alias("bearing"),
        F.col("value").cast("float").alias("speed_mps"),
        F.col("value").alias("odometer_m"),
        (F.col("event_id") % 3).cast("smallint").alias("current_status"),
        (F.col("event_id") % 7).cast("int").alias("current_stop_sequence"),
        (u % 5).cast("string").alias("stop_id"),
        F.lit(None).cast("smallint").alias("congestion_level"),
        F.lit(None).cast("smallint").alias("occupancy_status"),
        F.sha2(F.col("event_id").cast("string"), 256).alias("raw_payload_hash"),
        F.to_date("ts").alias("dt"),
    )


VP = """vp AS (
  SELECT ts AS received_at, ts AS feed_timestamp, 'ttc' AS agency_id,
    CAST(user_id AS VARCHAR) AS vehicle_id, CAST(event_id // 3 AS VARCHAR) AS trip_id,
    event_type AS route_id, CAST(user_id % 2 AS INTEGER) AS direction_id,
    43.5 + CAST(user_id * 37 % 1000 AS DOUBLE) / 2000 AS latitude,
    -79.6 + CAST(user_id * 91 % 1000 AS DOUBLE) / 2000 AS longitude,
    CAST(event_id % 360 AS FLOAT) AS bearing, CAST(value AS FLOAT) AS speed_mps,
    CAST(event_id % 3 AS INTEGER) AS current_status,
    CAST(event_id % 7 AS INTEGER) AS current_stop_sequence,
    CAST(user_id % 5 AS VARCHAR) AS stop_id, sha256(CAST(event_id AS VARCHAR)) AS raw_payload_hash
  FROM events)"""


def trip_updates(spark: SparkSession, d: str) -> DataFrame:
    return trip_updates_of(table(spark, d, "events"))


def trip_updates_of(e: DataFrame) -> DataFrame:
    u, i = F.col("user_id"), F.col("event_id")
    return e.select(
        ts("ts").alias("received_at"),
        ts("ts").alias("feed_timestamp"),
        F.lit(AGENCY).alias("agency_id"),
        F.expr("event_id div 3").cast("string").alias("trip_id"),
        F.col("event_type").alias("route_id"),
        (u % 2).cast("int").alias("direction_id"),
        F.when(i % 4 != 0, F.to_date("ts")).alias("start_date"),
        F.lit(0).cast("smallint").alias("schedule_relationship"),
        (i % 7).cast("int").alias("stop_sequence"),
        (u % 5).cast("string").alias("stop_id"),
        ts("ts").alias("arrival_time"),
        F.lit(None).cast("int").alias("arrival_delay_s"),
        ts("ts").alias("departure_time"),
        F.lit(None).cast("int").alias("departure_delay_s"),
        F.sha2(i.cast("string"), 256).alias("raw_payload_hash"),
        F.to_date("ts").alias("dt"),
    )


TU = """tu AS (
  SELECT ts AS received_at, CAST(event_id // 3 AS VARCHAR) AS trip_id, event_type AS route_id,
    CAST(user_id % 2 AS INTEGER) AS direction_id,
    CASE WHEN event_id % 4 <> 0 THEN CAST(ts AS DATE) END AS start_date,
    CAST(event_id % 7 AS INTEGER) AS stop_sequence,
    CAST(user_id % 5 AS VARCHAR) AS stop_id, ts AS arrival_time
  FROM events)"""


# --- stops: customers; routes: parts ---------------------------------------------------


def stops(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(
        k.cast("string").alias("stop_id"),
        F.col("c_mktsegment").alias("stop_code"),
        F.col("c_name").alias("stop_name"),
        (F.lit(43.5) + (k * 37 % 1000) / 2000).alias("latitude"),
        (F.lit(-79.6) + (k * 91 % 1000) / 2000).alias("longitude"),
    )


STOPS = """stops AS (
  SELECT CAST(c_custkey AS VARCHAR) AS stop_id, c_mktsegment AS stop_code, c_name AS stop_name,
    43.5 + CAST(c_custkey * 37 % 1000 AS DOUBLE) / 2000 AS latitude,
    -79.6 + CAST(c_custkey * 91 % 1000 AS DOUBLE) / 2000 AS longitude
  FROM customer)"""


def points(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(
        k.alias("point_id"),
        (F.lit(43.45) + (k * 53 % 1000) / 1700).alias("latitude"),
        (F.lit(-79.65) + (k * 29 % 1000) / 1700).alias("longitude"),
    )


POINTS = """points AS (
  SELECT s_suppkey AS point_id,
    43.45 + CAST(s_suppkey * 53 % 1000 AS DOUBLE) / 1700 AS latitude,
    -79.65 + CAST(s_suppkey * 29 % 1000 AS DOUBLE) / 1700 AS longitude
  FROM supplier)"""


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    dlat = f"sin((radians({lat2}) - radians({lat1})) / 2)"
    dlon = f"sin((radians({lon2}) - radians({lon1})) / 2)"
    return (
        "12742017.5428 * asin(sqrt(least(1.0, "
        f"{dlat} * {dlat} + cos(radians({lat1})) * cos(radians({lat2})) * {dlon} * {dlon})))"
    )


def routes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, d, "part").select(
        F.concat(F.lit("r-"), k).alias("route_id"),
        k.cast("string").alias("route_short_name"),
        F.initcap("p_name").alias("route_long_name"),
        F.when(k % 11 != 0, (F.col("p_size") % 4).cast("int")).alias("route_type"),
    )


ROUTES = """routes AS (
  SELECT 'r-' || p_partkey AS route_id, CAST(p_partkey AS VARCHAR) AS route_short_name,
    upper(p_name[1]) || substr(p_name, 2, position(' ' IN p_name) - 1)
      || upper(substr(p_name, position(' ' IN p_name) + 1, 1))
      || substr(p_name, position(' ' IN p_name) + 2) AS route_long_name,
    CASE WHEN p_partkey % 11 <> 0 THEN CAST(p_size % 4 AS INTEGER) END AS route_type
  FROM part)"""


def route_queries(spark: SparkSession, d: str) -> DataFrame:
    """What riders ask for: numbers, words, parts of names and nonsense."""
    k, name = F.col("p_partkey"), F.col("p_name")
    text = (
        F.when(k % 4 == 0, F.concat(F.lit("  "), k, F.lit(" ")))
        .when(k % 4 == 1, F.upper(F.element_at(F.split(name, " "), -1)))
        .when(k % 4 == 2, F.substring(name, 3, 6))
        .otherwise(F.concat(name, F.lit(" "), k))
    )
    return table(spark, d, "part").select(k.alias("query_id"), text.alias("route_text"))


ROUTE_QUERIES = """asked AS (
  SELECT p_partkey AS query_id, CASE p_partkey % 4
    WHEN 0 THEN '  ' || p_partkey || ' '
    WHEN 1 THEN upper(split_part(p_name, ' ', 2))
    WHEN 2 THEN substr(p_name, 3, 6)
    ELSE p_name || ' ' || p_partkey END AS route_text
  FROM part)"""


# --- schedule: distinct line items -----------------------------------------------------


def stop_times(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem")
    return line.groupBy(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        F.col("l_linenumber").alias("stop_sequence"),
    ).agg(
        F.min(F.col("l_partkey") * 37 % 90000).cast("int").alias("arrival_s"),
        F.min("l_suppkey").cast("string").alias("stop_id"),
    )


STOP_TIMES = """st AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, l_linenumber AS stop_sequence,
    CAST(min(l_partkey * 37 % 90000) AS INTEGER) AS arrival_s
  FROM lineitem GROUP BY ALL)"""


# --- operational tables: orders -------------------------------------------------------


def runs(spark: SparkSession, d: str) -> DataFrame:
    status = (
        F.when(F.col("o_orderstatus") == "F", "success")
        .when(F.col("o_orderstatus") == "O", "running")
        .otherwise("failure")
    )
    done = ts("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(5), F.lit(0))
    return table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("asset_key"),
        ts("o_orderdate").alias("started_at"),
        done.alias("completed_at"),
        status.alias("status"),
        F.col("o_custkey").alias("records_written"),
    )


RUNS = """runs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS asset_key,
    CAST(o_orderdate AS TIMESTAMP) AS started_at,
    CAST(o_orderdate AS TIMESTAMP) + INTERVAL 5 MINUTE AS completed_at,
    CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'running' ELSE 'failure' END AS status,
    o_custkey AS records_written
  FROM orders)"""


def freshness_history(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        ts("ts").alias("snapshot_at"),
        F.col("event_type").alias("feed_key"),
        ts("ts").alias("last_record_at"),
        (F.col("event_id") % 50).alias("record_count_5min"),
        (F.col("event_id") % 600).alias("record_count_1h"),
        (F.col("value") * 10).cast("int").alias("lag_seconds"),
        F.when(F.col("value") < 5, "healthy").otherwise("lagging").alias("status"),
    )


HISTORY = """history AS (
  SELECT ts AS snapshot_at, event_type AS feed_key, ts AS last_record_at,
    event_id % 50 AS record_count_5min, event_id % 600 AS record_count_1h,
    CAST(trunc(value * 10) AS INTEGER) AS lag_seconds,
    CASE WHEN value < 5 THEN 'healthy' ELSE 'lagging' END AS status
  FROM events)"""


# --- feed messages ----------------------------------------------------------------------


def position_messages(spark: SparkSession, d: str) -> DataFrame:
    """One message per event, with the fields set or not in turn."""
    e = table(spark, d, "events")
    i, u = F.col("event_id"), F.col("user_id")

    def unless(n: int, c: Column) -> Column:
        return F.when(i % n != 0, c)

    trip = F.struct(
        unless(5, F.expr("event_id div 3").cast("string")).alias("trip_id"),
        F.col("event_type").alias("route_id"),
        (u % 2).cast("int").alias("direction_id"),
        F.date_format("ts", "yyyyMMdd").alias("start_date"),
        F.lit("SCHEDULED").alias("schedule_relationship"),
    )
    position = F.struct(
        (F.lit(43.5) + (u * 37 % 1000) / 2000).cast("float").alias("latitude"),
        (F.lit(-79.6) + (u * 91 % 1000) / 2000).cast("float").alias("longitude"),
        unless(3, (i % 360).cast("float")).alias("bearing"),
        F.col("value").cast("float").alias("speed"),
        F.col("value").alias("odometer"),
    )
    status = F.element_at(
        F.array(*[F.lit(x) for x in ("INCOMING_AT", "STOPPED_AT", "IN_TRANSIT_TO")]),
        (i % 3 + 1).cast("int"),
    )
    vehicle = F.struct(
        F.struct(unless(11, u.cast("string")).alias("id")).alias("vehicle"),
        unless(9, trip).alias("trip"),
        F.when(F.col("event_type") != "error", position).alias("position"),
        status.alias("current_status"),
        (i % 7).cast("int").alias("current_stop_sequence"),
        (u % 5).cast("string").alias("stop_id"),
        F.lit(None).cast("string").alias("congestion_level"),
        unless(4, F.lit("FULL")).alias("occupancy_status"),
    )
    return e.select(
        ts("ts").alias("received_at"),
        F.sha2(i.cast("string"), 256).alias("payload_hash"),
        F.struct(
            unless(6, F.unix_seconds(ts("ts")).cast("string")).alias("timestamp")
        ).alias("header"),
        F.array(F.struct(i.cast("string").alias("id"), vehicle.alias("vehicle"))).alias("entity"),
    )


def trip_messages(spark: SparkSession, d: str) -> DataFrame:
    """One message per trip: three events are its three stops."""
    e = table(spark, d, "events")
    i = F.col("event_id")
    epoch = F.unix_seconds(ts("ts"))
    stop = F.struct(
        i.alias("i"),
        (i % 7).cast("int").alias("stop_sequence"),
        (F.col("user_id") % 5).cast("string").alias("stop_id"),
        F.when(
            i % 4 != 0,
            F.struct(epoch.cast("string").alias("time"), (i % 90).cast("int").alias("delay")),
        ).alias("arrival"),
        F.struct(
            (epoch + 20).cast("string").alias("time"), F.lit(None).cast("int").alias("delay")
        ).alias("departure"),
    )
    trips = e.groupBy(F.expr("event_id div 3").alias("trip")).agg(
        F.max(ts("ts")).alias("received_at"),
        F.array_sort(F.collect_list(stop)).alias("stops"),
    )
    when = F.when(F.col("trip") % 5 == 0, F.lit("20261341")).otherwise(
        F.date_format("received_at", "yyyyMMdd")
    )
    trip = F.struct(
        F.col("trip").cast("string").alias("trip_id"),
        F.when(F.col("trip") % 3 != 0, F.lit("R1")).alias("route_id"),
        (F.col("trip") % 2).cast("int").alias("direction_id"),
        when.alias("start_date"),
        F.lit("CANCELED").alias("schedule_relationship"),
    )
    update = F.struct(trip.alias("trip"), F.col("stops").alias("stop_time_update"))
    return trips.select(
        "received_at",
        F.sha2(F.col("trip").cast("string"), 256).alias("payload_hash"),
        F.struct(F.unix_seconds("received_at").cast("string").alias("timestamp")).alias("header"),
        F.array(
            F.struct(F.col("trip").cast("string").alias("id"), update.alias("trip_update"))
        ).alias("entity"),
    )


def alert_messages(spark: SparkSession, d: str) -> DataFrame:
    """One message per turn of a conversation; the turns of one are polls of one alert."""
    c = table(spark, d, "conversations")
    turn, conv = F.col("turn"), F.col("conv_id")

    def line(language: str, text: Column) -> Column:
        return F.struct(text.alias("text"), F.lit(language).alias("language"))

    header = F.when(turn % 3 == 0, F.array(line("fr", F.col("role")), line("en-CA", F.col("text")))).otherwise(
        F.array(line("fr", F.col("text")), line("de", F.col("role")))
    )

    def about(route: Column, stop: Column) -> Column:
        return F.struct(
            route.alias("route_id"),
            stop.alias("stop_id"),
            F.lit(None).cast("struct<trip_id:string>").alias("trip"),
        )

    none = F.lit(None).cast("string")
    informed = F.array(
        about(F.concat(F.lit("r"), turn), none),
        about(F.concat(F.lit("r"), conv % 3), F.concat(F.lit("s"), turn)),
        about(F.concat(F.lit("r"), turn), none),
    )
    start = F.lit(1_700_000_000) + conv * 1000 + turn * 60
    alert = F.struct(
        F.lit("MAINTENANCE").alias("cause"),
        F.lit("4").alias("effect"),
        F.lit(None).cast("string").alias("severity_level"),
        F.struct(header.alias("translation")).alias("header_text"),
        F.lit(None).cast("struct<translation:array<struct<text:string,language:string>>>").alias(
            "description_text"
        ),
        informed.alias("informed_entity"),
        F.when(
            turn % 2 == 0,
            F.array(
                F.struct(start.cast("string").alias("start"), F.lit(None).cast("string").alias("end"))
            ),
        ).alias("active_period"),
    )
    return c.select(
        F.timestamp_seconds(start).alias("received_at"),
        F.sha2(F.concat_ws("-", conv, turn), 256).alias("payload_hash"),
        F.struct(start.cast("string").alias("timestamp")).alias("header"),
        F.array(F.struct(conv.cast("string").alias("id"), alert.alias("alert"))).alias("entity"),
    )


def _encode(chunks):
    import json

    import pandas as pd
    from google.protobuf.json_format import ParseDict

    from stopclock import schemas as S
    from stopclock.sources.payloads import message_class

    feed = message_class()
    codes = {**S.VEHICLE_STOP_STATUS, **S.OCCUPANCY_STATUS, **S.SCHEDULE_RELATIONSHIP}

    def numbered(value):
        if isinstance(value, dict):
            return {k: numbered(v) for k, v in value.items()}
        if isinstance(value, list):
            return [numbered(v) for v in value]
        return codes.get(value, value) if isinstance(value, str) else value

    for chunk in chunks:
        yield pd.Series([ParseDict(numbered(json.loads(t)), feed()).SerializeToString() for t in chunk])


def as_payloads(messages: DataFrame) -> DataFrame:
    """Messages in their binary form, with the time they were received."""
    from collections.abc import Iterator

    import pandas as pd

    _encode.__annotations__ = {"chunks": Iterator[pd.Series], "return": Iterator[pd.Series]}
    encode = F.pandas_udf(_encode, "binary")
    return messages.select(
        "received_at", encode(F.to_json(F.struct("header", "entity"))).alias("content")
    )
