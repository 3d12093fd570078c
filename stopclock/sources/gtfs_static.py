"""Unpacked static archive: one CSV file with a header row per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopclock.storage import exists

# The columns of the public static format that are used.
FILES = {
    "agency": ("agency_id", "agency_name", "agency_url", "agency_timezone", "agency_lang"),
    "routes": (
        "route_id",
        "agency_id",
        "route_short_name",
        "route_long_name",
        "route_type",
        "route_color",
        "route_text_color",
    ),
    "stops": (
        "stop_id",
        "stop_code",
        "stop_name",
        "stop_desc",
        "stop_lat",
        "stop_lon",
        "zone_id",
        "location_type",
        "parent_station",
    ),
    "trips": (
        "trip_id",
        "route_id",
        "service_id",
        "trip_headsign",
        "direction_id",
        "block_id",
        "shape_id",
    ),
    "stop_times": (
        "trip_id",
        "stop_sequence",
        "stop_id",
        "arrival_time",
        "departure_time",
        "pickup_type",
        "drop_off_type",
        "shape_dist_traveled",
    ),
    "calendar": (
        "service_id",
        "monday",
        "tuesday",
        "wednesday",
        "thursday",
        "friday",
        "saturday",
        "sunday",
        "start_date",
        "end_date",
    ),
    "calendar_dates": ("service_id", "date", "exception_type"),
    "shapes": (
        "shape_id",
        "shape_pt_sequence",
        "shape_pt_lat",
        "shape_pt_lon",
        "shape_dist_traveled",
    ),
}
MANDATORY = ("stop_times",)
LARGE = ("stop_times", "shapes")


def open_quotes(spark: SparkSession, path: str) -> int:
    """Lines of a CSV file with an odd number of quotes: a quoted field goes on in the next."""
    lines = spark.read.text(path)
    return lines.filter(F.regexp_count("value", F.lit('"')) % 2 == 1).count()


def scan_gtfs(
    spark: SparkSession, folder: str, with_shapes: bool = False
) -> dict[str, DataFrame]:
    """All tables of an archive folder as text columns, chosen by header name.

    A missing column is NULL; a missing file is an empty table, except ``stop_times``,
    without which the archive is refused.

    Quoted line breaks occur in names and descriptions.  The two large tables hold ids and
    numbers, so they are read in splits, unless a scan of their lines finds a quoted field
    that is open at a line's end.
    """
    tables = {}
    for name, columns in FILES.items():
        if name == "shapes" and not with_shapes:
            continue
        wanted = columns
        path = f"{folder.rstrip('/')}/{name}.txt"
        if not exists(spark, path):
            if name in MANDATORY:
                raise FileNotFoundError(f"{path} is missing")
            ddl = ", ".join(f"`{c}` string" for c in wanted)
            tables[name] = spark.createDataFrame([], ddl)
            continue
        raw = (
            spark.read.option("header", True)
            .option("inferSchema", False)
            .option("quote", '"')
            .option("escape", '"')
            .option("multiLine", name not in LARGE or open_quotes(spark, path) > 0)
            .csv(path)
        )
        present = {c.strip(): c for c in raw.columns}
        tables[name] = raw.select(
            *[
                F.col(f"`{present[c]}`").alias(c)
                if c in present
                else F.lit(None).cast("string").alias(c)
                for c in wanted
            ]
        )
    return tables
