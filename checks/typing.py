"""Value-level queries for the static typers and for branches that no other query takes."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.registry import query
from stopclock.operators import delay, names, static_tables

DAY = "2026-04-14"


@query(
    "type_agency",
    f"""SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'ttc' ELSE CAST(s_suppkey AS VARCHAR) END AS agency_id,
      s_name AS agency_name, NULL::VARCHAR AS agency_url, 'America/Toronto' AS agency_timezone,
      CASE WHEN s_nationkey % 2 = 0 THEN 'en' END AS agency_lang, '{DAY}' AS snapshot_date FROM supplier""",
)
def _(spark, d):
    k = F.col("s_suppkey")
    raw = V.table(spark, d, "supplier").select(
        F.when(k % 3 == 0, " ").otherwise(F.concat(F.lit("\t"), k)).alias("agency_id"),
        F.concat(F.lit(" "), "s_name").alias("agency_name"),
        F.lit(" ").alias("agency_url"),
        F.lit("America/Toronto ").alias("agency_timezone"),
        F.when(F.col("s_nationkey") % 2 == 0, "en").otherwise("").alias("agency_lang"),
    )
    return static_tables.type_agency(raw, DAY)


@query(
    "type_routes",
    f"""SELECT CAST(p_partkey AS VARCHAR) AS route_id, 'ttc' AS agency_id, p_brand AS route_short_name,
      p_name AS route_long_name, CASE WHEN p_size % 4 <> 3 THEN p_size END AS route_type,
      p_type AS route_color, NULL::VARCHAR AS route_text_color, '{DAY}' AS snapshot_date FROM part""",
)
def _(spark, d):
    size = F.col("p_size")
    raw = V.table(spark, d, "part").select(
        F.concat(F.col("p_partkey"), F.lit(" ")).alias("route_id"),
        F.lit("").alias("agency_id"),
        F.col("p_brand").alias("route_short_name"),
        F.concat(F.lit("  "), "p_name").alias("route_long_name"),
        F.when(size % 4 != 3, F.concat(F.lit(" "), size)).otherwise("bus").alias("route_type"),
        F.col("p_type").alias("route_color"),
        F.lit(None).cast("string").alias("route_text_color"),
    )
    return static_tables.type_routes(raw, DAY)


@query(
    "type_trips",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_custkey AS VARCHAR) AS route_id,
      o_orderpriority AS service_id, NULL::VARCHAR AS trip_headsign,
      CASE o_orderkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 END AS direction_id,
      o_orderstatus AS block_id, CAST(o_custkey % 50 AS VARCHAR) AS shape_id,
      '{DAY}' AS snapshot_date FROM orders""",
)
def _(spark, d):
    k = F.col("o_orderkey")
    raw = V.table(spark, d, "orders").select(
        F.concat(F.lit(" "), k).alias("trip_id"),
        F.col("o_custkey").cast("string").alias("route_id"),
        F.concat("o_orderpriority", F.lit("\n")).alias("service_id"),
        F.lit("\t").alias("trip_headsign"),
        F.when(k % 3 < 2, (k % 3).cast("string")).otherwise("in").alias("direction_id"),
        F.col("o_orderstatus").alias("block_id"),
        (F.col("o_custkey") % 50).cast("string").alias("shape_id"),
    )
    return static_tables.type_trips(raw, DAY)


@query(
    "type_calendar_dates",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS service_id,
      CASE WHEN c_custkey % 5 <> 0 THEN strftime(DATE '2024-01-01' + CAST(c_custkey % 400 AS INTEGER), '%Y-%m-%d') END AS exception_date,
      CASE WHEN c_custkey % 3 > 0 THEN CAST(c_custkey % 3 AS INTEGER) END AS exception_type,
      '{DAY}' AS snapshot_date FROM customer""",
)
def _(spark, d):
    k = F.col("c_custkey")
    date = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (k % 400).cast("int")), "yyyyMMdd")
    raw = V.table(spark, d, "customer").select(
        k.cast("string").alias("service_id"),
        F.when(k % 5 != 0, F.concat(F.lit(" "), date)).otherwise("20241341").alias("date"),
        F.when(k % 3 > 0, (k % 3).cast("string")).otherwise("").alias("exception_type"),
    )
    return static_tables.type_calendar_dates(raw, DAY)


@query(
    "type_shapes",
    f"""SELECT CAST(l_orderkey AS VARCHAR) AS shape_id, CAST(l_linenumber AS INTEGER) AS shape_pt_sequence,
      l_discount * 100 AS latitude, CASE WHEN l_linenumber <> 2 THEN -l_tax * 100 END AS longitude,
      l_quantity AS shape_dist_traveled, '{DAY}' AS snapshot_date FROM lineitem""",
)
def _(spark, d):
    raw = V.table(spark, d, "lineitem").select(
        F.concat("l_orderkey", F.lit("\t")).alias("shape_id"),
        F.concat(F.lit(" "), "l_linenumber").alias("shape_pt_sequence"),
        (F.col("l_discount") * 100).cast("string").alias("shape_pt_lat"),
        F.when(F.col("l_linenumber") != 2, (-F.col("l_tax") * 100).cast("string")).otherwise("west").alias("shape_pt_lon"),
        F.concat(F.col("l_quantity"), F.lit(" ")).alias("shape_dist_traveled"),
    )
    return static_tables.type_shapes(raw, DAY)


@query(
    "agency_zone",
    """SELECT l_orderkey, l_linenumber, CASE l_suppkey % 3 WHEN 0 THEN 'America/Toronto' WHEN 1 THEN 'UTC' END
      AS agency_zone FROM lineitem""",
)
def _(spark, d):
    k = F.col("s_suppkey")
    agency = V.table(spark, d, "supplier").filter(k % 3 < 2).select(
        k.cast("string").alias("agency_id"), F.when(k % 3 == 0, "America/Toronto").otherwise("UTC").alias("agency_timezone")
    )
    rows = V.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("agency_id"))
    return delay.with_agency_zone(rows, agency).drop("agency_id")


@query(
    "agencies_empty",
    """SELECT 'ttc' AS agency_id, 'Toronto Transit Commission' AS name, 'America/Toronto' AS timezone
    WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey < 0)""",
)
def _(spark, d):
    none = V.table(spark, d, "supplier").filter("s_suppkey < 0").select(
        F.col("s_suppkey").cast("string").alias("agency_id"),
        F.col("s_name").alias("agency_name"),
        F.lit("UTC").alias("agency_timezone"),
    )
    return names.agencies(none, ("ttc", "Toronto Transit Commission", "America/Toronto"))
