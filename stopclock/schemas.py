"""Table schemas, keys and the constants of the data model.

A ``Table`` carries the declared columns, the key and the columns that must be set.
Readers and writers always use the declared schema, never an inferred one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    key: tuple[str, ...]
    required: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def must_be_set(self) -> tuple[str, ...]:
        return self.key + tuple(c for c in self.required if c not in self.key)


# --- static schedule tables ---------------------------------------------------------

AGENCY = Table(
    "agency",
    "agency_id string, agency_name string, agency_url string, agency_timezone string, "
    "agency_lang string, snapshot_date date",
    ("agency_id",),
    ("agency_name", "agency_timezone", "snapshot_date"),
)
ROUTES = Table(
    "routes",
    "route_id string, agency_id string, route_short_name string, route_long_name string, "
    "route_type int, route_color string, route_text_color string, snapshot_date date",
    ("route_id",),
    ("agency_id", "route_type", "snapshot_date"),
)
STOPS = Table(
    "stops",
    "stop_id string, stop_code string, stop_name string, stop_desc string, "
    "latitude double, longitude double, zone_id string, location_type int, "
    "parent_station string, snapshot_date date",
    ("stop_id",),
    ("stop_name", "latitude", "longitude", "snapshot_date"),
)
TRIPS = Table(
    "trips",
    "trip_id string, route_id string, service_id string, trip_headsign string, "
    "direction_id int, block_id string, shape_id string, snapshot_date date",
    ("trip_id",),
    ("route_id", "service_id", "snapshot_date"),
)
STOP_TIMES = Table(
    "stop_times",
    "trip_id string, stop_sequence int, stop_id string, "
    "arrival_time interval day to second, departure_time interval day to second, "
    "arrival_s int, departure_s int, "
    "pickup_type int, drop_off_type int, shape_dist_traveled double, snapshot_date date",
    ("trip_id", "stop_sequence"),
    ("stop_id", "snapshot_date"),
)
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
CALENDAR = Table(
    "calendar",
    "service_id string, "
    + ", ".join(f"{d} boolean" for d in WEEKDAYS)
    + ", start_date date, end_date date, snapshot_date date",
    ("service_id",),
    WEEKDAYS + ("start_date", "end_date", "snapshot_date"),
)
CALENDAR_DATES = Table(
    "calendar_dates",
    "service_id string, exception_date date, exception_type int, snapshot_date date",
    ("service_id", "exception_date"),
    ("exception_type", "snapshot_date"),
)
SHAPES = Table(
    "shapes",
    "shape_id string, shape_pt_sequence int, latitude double, longitude double, "
    "shape_dist_traveled double, snapshot_date date",
    ("shape_id", "shape_pt_sequence"),
    ("latitude", "longitude", "snapshot_date"),
)
STATIC_TABLES = {
    t.name: t
    for t in (AGENCY, ROUTES, STOPS, TRIPS, STOP_TIMES, CALENDAR, CALENDAR_DATES, SHAPES)
}
# child table -> (child columns, parent table, parent columns)
STATIC_REFERENCES = (
    ("trips", ("route_id",), "routes", ("route_id",)),
    ("stop_times", ("stop_id",), "stops", ("stop_id",)),
)

# --- event tables -------------------------------------------------------------------

VEHICLE_POSITIONS = Table(
    "vehicle_positions",
    "received_at timestamp, feed_timestamp timestamp, agency_id string, vehicle_id string, "
    "trip_id string, route_id string, direction_id int, latitude double, longitude double, "
    "bearing float, speed_mps float, odometer_m double, current_status smallint, "
    "current_stop_sequence int, stop_id string, congestion_level smallint, "
    "occupancy_status smallint, raw_payload_hash string",
    ("received_at", "agency_id", "vehicle_id", "feed_timestamp"),
    ("latitude", "longitude"),
)
TRIP_UPDATES = Table(
    "trip_updates",
    "received_at timestamp, feed_timestamp timestamp, agency_id string, trip_id string, "
    "route_id string, direction_id int, start_date date, schedule_relationship smallint, "
    "stop_sequence int, stop_id string, arrival_time timestamp, arrival_delay_s int, "
    "departure_time timestamp, departure_delay_s int, raw_payload_hash string",
    ("received_at", "agency_id", "trip_id", "stop_sequence", "feed_timestamp"),
)
SERVICE_ALERTS = Table(
    "service_alerts",
    "alert_id string, agency_id string, first_seen_at timestamp, last_seen_at timestamp, "
    "feed_timestamp timestamp, cause smallint, effect smallint, severity_level smallint, "
    "header_text string, description_text string, affected_routes array<string>, "
    "affected_stops array<string>, affected_trips array<string>, "
    "active_period_start timestamp, active_period_end timestamp, raw_payload_hash string",
    ("agency_id", "alert_id"),
    ("first_seen_at", "last_seen_at", "feed_timestamp"),
)
EVENT_TABLES = {t.name: t for t in (VEHICLE_POSITIONS, TRIP_UPDATES)}

# --- operational tables -------------------------------------------------------------

FRESHNESS = Table(
    "freshness_snapshot",
    "snapshot_at timestamp, feed_key string, last_record_at timestamp, "
    "record_count_5min bigint, record_count_1h bigint, lag_seconds int, status string",
    ("snapshot_at", "feed_key"),
    ("record_count_5min", "record_count_1h", "status"),
)
RUNS = Table(
    "ingestion_runs",
    "run_id string, asset_key string, started_at timestamp, completed_at timestamp, "
    "status string, records_written bigint, bytes_processed bigint, error_class string, "
    "error_message string",
    ("run_id",),
    ("asset_key", "started_at", "status"),
)
FAILURES = Table(
    "ingestion_failures",
    "failure_id string, occurred_at timestamp, feed_key string, error_class string, "
    "error_message string, sample_payload binary, sample_payload_truncated boolean, "
    "retry_count int, resolved_at timestamp",
    ("failure_id",),
    ("occurred_at", "feed_key", "error_class", "sample_payload_truncated", "retry_count"),
)
SIGNATURES = Table(
    "feed_field_signatures",
    "feed_key string, signature_hash string, populated_fields array<string>, "
    "first_seen_at timestamp, last_seen_at timestamp, sample_count bigint",
    ("feed_key", "signature_hash"),
    ("populated_fields", "first_seen_at", "last_seen_at", "sample_count"),
)
STOP_DELAY = Table(
    "stop_delay",
    "start_date date, trip_id string, stop_sequence int, route_id string, stop_id string, "
    "scheduled_at timestamp, arrival_at timestamp, delay_s int, status string, "
    "updated_at timestamp",
    ("start_date", "trip_id", "stop_sequence"),
    ("status", "updated_at"),
)

# Predictions still open, beside the frozen rows of ``stop_delay``; and which micro-batch
# wrote a row.
STOP_DELAY_OPEN = Table(
    "stop_delay_open",
    f"{STOP_DELAY.ddl}, batch_id bigint",
    STOP_DELAY.key,
    (*STOP_DELAY.must_be_set, "batch_id"),
)
# Poll files that were landed: a poll is told by its time and content, not by its file.
LANDED_POLLS = Table(
    "landed_polls",
    "feed_key string, received_at timestamp, payload_hash string, path string, token string",
    ("feed_key", "received_at", "payload_hash"),
    ("path",),
)

# --- constants ----------------------------------------------------------------------

# The agency that is meant when a file names none, and its catalog row.
DEFAULT_AGENCY_ID = "ttc"
DEFAULT_AGENCY = ("ttc", "Toronto Transit Commission", "America/Toronto")

# Largest lag in seconds for healthy, lagging and stale, per feed.
FRESHNESS_THRESHOLDS = {
    "ttc.vehicle_positions": (60, 180, 600),
    "ttc.trip_updates": (60, 180, 600),
    "ttc.service_alerts": (600, 1800, 3600),
}
DEFAULT_THRESHOLDS = (60, 180, 600)

# Days that the event tables keep.
HOT_DAYS = 3

# Enum numbers of the public feed specification.
VEHICLE_STOP_STATUS = {"INCOMING_AT": 0, "STOPPED_AT": 1, "IN_TRANSIT_TO": 2}
CONGESTION_LEVEL = {
    "UNKNOWN_CONGESTION_LEVEL": 0,
    "RUNNING_SMOOTHLY": 1,
    "STOP_AND_GO": 2,
    "CONGESTION": 3,
    "SEVERE_CONGESTION": 4,
}
OCCUPANCY_STATUS = {
    "EMPTY": 0,
    "MANY_SEATS_AVAILABLE": 1,
    "FEW_SEATS_AVAILABLE": 2,
    "STANDING_ROOM_ONLY": 3,
    "CRUSHED_STANDING_ROOM_ONLY": 4,
    "FULL": 5,
    "NOT_ACCEPTING_PASSENGERS": 6,
    "NO_DATA_AVAILABLE": 7,
    "NOT_BOARDABLE": 8,
}
SCHEDULE_RELATIONSHIP = {
    "SCHEDULED": 0,
    "ADDED": 1,
    "UNSCHEDULED": 2,
    "CANCELED": 3,
    "REPLACEMENT": 5,
    "DUPLICATED": 6,
    "DELETED": 7,
}
ALERT_CAUSE = {
    "UNKNOWN_CAUSE": 1,
    "OTHER_CAUSE": 2,
    "TECHNICAL_PROBLEM": 3,
    "STRIKE": 4,
    "DEMONSTRATION": 5,
    "ACCIDENT": 6,
    "HOLIDAY": 7,
    "WEATHER": 8,
    "MAINTENANCE": 9,
    "CONSTRUCTION": 10,
    "POLICE_ACTIVITY": 11,
    "MEDICAL_EMERGENCY": 12,
}
ALERT_EFFECT = {
    "NO_SERVICE": 1,
    "REDUCED_SERVICE": 2,
    "SIGNIFICANT_DELAYS": 3,
    "DETOUR": 4,
    "ADDITIONAL_SERVICE": 5,
    "MODIFIED_SERVICE": 6,
    "OTHER_EFFECT": 7,
    "UNKNOWN_EFFECT": 8,
    "STOP_MOVED": 9,
    "NO_EFFECT": 10,
    "ACCESSIBILITY_ISSUE": 11,
}
ALERT_SEVERITY = {"UNKNOWN_SEVERITY": 1, "INFO": 2, "WARNING": 3, "SEVERE": 4}

# --- feed message -------------------------------------------------------------------
# Landing files follow the protobuf JSON mapping: 64-bit numbers and enums come as text,
# so those fields are declared as text here and converted by ``normalize_feed``.

_TRIP = (
    "struct<trip_id:string, route_id:string, direction_id:int, start_date:string, "
    "schedule_relationship:string>"
)
_TEXT = "struct<translation:array<struct<text:string, language:string>>>"
_EVENT = "struct<time:string, delay:int>"
_VEHICLE = (
    f"struct<vehicle:struct<id:string>, trip:{_TRIP}, "
    "position:struct<latitude:float, longitude:float, bearing:float, speed:float, "
    "odometer:double>, current_status:string, current_stop_sequence:int, stop_id:string, "
    "congestion_level:string, occupancy_status:string>"
)
_TRIP_UPDATE = (
    f"struct<trip:{_TRIP}, stop_time_update:array<struct<stop_sequence:int, "
    f"stop_id:string, arrival:{_EVENT}, departure:{_EVENT}>>>"
)
_ALERT = (
    "struct<cause:string, effect:string, severity_level:string, "
    f"header_text:{_TEXT}, description_text:{_TEXT}, "
    f"informed_entity:array<struct<route_id:string, stop_id:string, trip:{_TRIP}>>, "
    "active_period:array<struct<start:string, end:string>>>"
)
FEED_DDL = (
    "header struct<gtfs_realtime_version:string, timestamp:string>, "
    f"entity array<struct<id:string, vehicle:{_VEHICLE}, trip_update:{_TRIP_UPDATE}, "
    f"alert:{_ALERT}>>"
)
