"""Text columns of the static archive to typed tables.

Each function is one projection.  A value that does not convert becomes NULL and is
reported by ``conversion_faults``; it does not fail the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopclock import schemas as S
from stopclock.functions import text as X
from stopclock.functions import times as M


def _stamp(snapshot_date) -> Column:
    return M.day(snapshot_date).alias("snapshot_date")


def _texts(*names: str) -> list[Column]:
    return [X.text_or_null(F.col(n)).alias(n) for n in names]


def _ints(*names: str) -> list[Column]:
    return [X.int_or_null(F.col(n)).alias(n) for n in names]


def _agency_id() -> Column:
    known = X.text_or_null(F.col("agency_id"))
    return F.coalesce(known, F.lit(S.DEFAULT_AGENCY_ID)).alias("agency_id")


def type_agency(df: DataFrame, snapshot_date) -> DataFrame:
    return df.select(
        _agency_id(),
        *_texts("agency_name", "agency_url", "agency_timezone", "agency_lang"),
        _stamp(snapshot_date),
    )


def type_routes(df: DataFrame, snapshot_date) -> DataFrame:
    return df.select(
        *_texts("route_id"),
        _agency_id(),
        *_texts("route_short_name", "route_long_name"),
        *_ints("route_type"),
        *_texts("route_color", "route_text_color"),
        _stamp(snapshot_date),
    )


def type_stops(df: DataFrame, snapshot_date) -> DataFrame:
    return df.select(
        *_texts("stop_id", "stop_code", "stop_name", "stop_desc"),
        X.double_or_null(F.col("stop_lat")).alias("latitude"),
        X.double_or_null(F.col("stop_lon")).alias("longitude"),
        *_texts("zone_id"),
        *_ints("location_type"),
        *_texts("parent_station"),
        _stamp(snapshot_date),
    )


def type_trips(df: DataFrame, snapshot_date) -> DataFrame:
    return df.select(
        *_texts("trip_id", "route_id", "service_id", "trip_headsign"),
        *_ints("direction_id"),
        *_texts("block_id", "shape_id"),
        _stamp(snapshot_date),
    )


def type_stop_times(df: DataFrame, snapshot_date) -> DataFrame:
    typed = df.select(
        *_texts("trip_id"),
        *_ints("stop_sequence"),
        *_texts("stop_id"),
        M.gtfs_seconds(F.col("arrival_time")).alias("arrival_s"),
        M.gtfs_seconds(F.col("departure_time")).alias("departure_s"),
        *_ints("pickup_type", "drop_off_type"),
        X.double_or_null(F.col("shape_dist_traveled")).alias("shape_dist_traveled"),
        _stamp(snapshot_date),
    )
    # The intervals come from the finished seconds, so each text is read once.
    return typed.withColumns(
        {
            "arrival_time": M.seconds_to_interval(F.col("arrival_s")),
            "departure_time": M.seconds_to_interval(F.col("departure_s")),
        }
    ).select(*S.STOP_TIMES.columns)


def type_calendar(df: DataFrame, snapshot_date) -> DataFrame:
    return df.select(
        *_texts("service_id"),
        *[X.flag(F.col(d)).alias(d) for d in S.WEEKDAYS],
        M.compact_date(F.col("start_date")).alias("start_date"),
        M.compact_date(F.col("end_date")).alias("end_date"),
        _stamp(snapshot_date),
    )


def type_calendar_dates(df: DataFrame, snapshot_date) -> DataFrame:
    return df.select(
        *_texts("service_id"),
        M.compact_date(F.col("date")).alias("exception_date"),
        *_ints("exception_type"),
        _stamp(snapshot_date),
    )


def type_shapes(df: DataFrame, snapshot_date) -> DataFrame:
    return df.select(
        *_texts("shape_id"),
        *_ints("shape_pt_sequence"),
        X.double_or_null(F.col("shape_pt_lat")).alias("latitude"),
        X.double_or_null(F.col("shape_pt_lon")).alias("longitude"),
        X.double_or_null(F.col("shape_dist_traveled")).alias("shape_dist_traveled"),
        _stamp(snapshot_date),
    )


TYPERS = {
    "agency": type_agency,
    "routes": type_routes,
    "stops": type_stops,
    "trips": type_trips,
    "stop_times": type_stop_times,
    "calendar": type_calendar,
    "calendar_dates": type_calendar_dates,
    "shapes": type_shapes,
}

# Raw columns that hold something other than text, with their conversion.
_CONVERSIONS = {
    "routes": {"route_type": X.int_or_null},
    "stops": {
        "stop_lat": X.double_or_null,
        "stop_lon": X.double_or_null,
        "location_type": X.int_or_null,
    },
    "trips": {"direction_id": X.int_or_null},
    "stop_times": {
        "stop_sequence": X.int_or_null,
        "arrival_time": M.gtfs_seconds,
        "departure_time": M.gtfs_seconds,
        "pickup_type": X.int_or_null,
        "drop_off_type": X.int_or_null,
        "shape_dist_traveled": X.double_or_null,
    },
    "calendar": {"start_date": M.compact_date, "end_date": M.compact_date},
    "calendar_dates": {"date": M.compact_date, "exception_type": X.int_or_null},
    "shapes": {
        "shape_pt_sequence": X.int_or_null,
        "shape_pt_lat": X.double_or_null,
        "shape_pt_lon": X.double_or_null,
        "shape_dist_traveled": X.double_or_null,
    },
}


def conversion_faults(table: str, raw: DataFrame) -> DataFrame:
    """Per column, how many non-empty values did not convert (one pass over the table)."""
    rules = _CONVERSIONS.get(table, {})
    if not rules:
        return raw.sparkSession.createDataFrame(
            [], "table_name string, column_name string, n_faults bigint"
        )
    counts = raw.agg(
        *[
            F.count_if(X.malformed(F.col(c), convert(F.col(c)))).alias(c)
            for c, convert in rules.items()
        ]
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_faults")) for c in rules]
    )
    return counts.select(F.lit(table).alias("table_name"), F.inline(pairs)).filter(
        F.col("n_faults") > 0
    )
