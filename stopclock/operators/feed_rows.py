"""Feed messages to table rows.

Input: one row per poll with ``received_at``, ``payload_hash``, ``header``, ``entity``.
A poll file is one message, so the explode happens inside the task that read the file;
no shuffle takes place.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopclock import schemas as S
from stopclock.functions.text import english_text, sorted_set
from stopclock.functions.times import compact_date, epoch_to_ts


def _code(c: Column, names: Mapping[str, int]) -> Column:
    """Enum number from the enum's name, a number or digits; unset stays NULL.

    The names come first: a failed number conversion is the slow way to find one.
    """
    text = c.cast("string")
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(lookup[text].cast("smallint"), text.try_cast("smallint"))


def _feed_time() -> Column:
    return F.coalesce(epoch_to_ts(F.col("header.timestamp")), F.col("received_at"))


def _entities(feed_df: DataFrame, part: str, with_position: bool = False) -> DataFrame:
    explode = F.posexplode("entity") if with_position else F.explode("entity")
    names = ("position", "e") if with_position else ("e",)
    # An entity of a later piece of a large message stands behind those of the earlier.
    piece = ["piece"] if with_position and "piece" in feed_df.columns else []
    rows = feed_df.select(
        *piece,
        "received_at",
        _feed_time().alias("feed_timestamp"),
        F.col("payload_hash").alias("raw_payload_hash"),
        explode.alias(*names),
    ).filter(F.col(f"e.{part}").isNotNull())
    if piece:
        rows = rows.withColumn("position", F.col("piece").cast("long") * 2**31 + F.col("position"))
    return rows


def vehicle_position_rows(
    feed_df: DataFrame, agency_id: str = S.DEFAULT_AGENCY_ID
) -> DataFrame:
    """One row per vehicle entity that has a position."""
    rows = _entities(feed_df, "vehicle").filter(F.col("e.vehicle.position").isNotNull())
    v = "e.vehicle"
    return rows.select(
        "received_at",
        "feed_timestamp",
        F.lit(agency_id).alias("agency_id"),
        F.col(f"{v}.vehicle.id").alias("vehicle_id"),
        F.col(f"{v}.trip.trip_id").alias("trip_id"),
        F.col(f"{v}.trip.route_id").alias("route_id"),
        F.col(f"{v}.trip.direction_id").alias("direction_id"),
        F.col(f"{v}.position.latitude").cast("double").alias("latitude"),
        F.col(f"{v}.position.longitude").cast("double").alias("longitude"),
        F.col(f"{v}.position.bearing").alias("bearing"),
        F.col(f"{v}.position.speed").alias("speed_mps"),
        F.col(f"{v}.position.odometer").alias("odometer_m"),
        _code(F.col(f"{v}.current_status"), S.VEHICLE_STOP_STATUS).alias("current_status"),
        F.col(f"{v}.current_stop_sequence").alias("current_stop_sequence"),
        F.col(f"{v}.stop_id").alias("stop_id"),
        _code(F.col(f"{v}.congestion_level"), S.CONGESTION_LEVEL).alias("congestion_level"),
        _code(F.col(f"{v}.occupancy_status"), S.OCCUPANCY_STATUS).alias("occupancy_status"),
        "raw_payload_hash",
    )


def trip_update_rows(feed_df: DataFrame, agency_id: str = S.DEFAULT_AGENCY_ID) -> DataFrame:
    """One row per predicted stop of every trip update."""
    rows = _entities(feed_df, "trip_update").select(
        "received_at",
        "feed_timestamp",
        "raw_payload_hash",
        F.col("e.trip_update.trip").alias("trip"),
        F.explode("e.trip_update.stop_time_update").alias("s"),
    )
    return rows.select(
        "received_at",
        "feed_timestamp",
        F.lit(agency_id).alias("agency_id"),
        F.col("trip.trip_id").alias("trip_id"),
        F.col("trip.route_id").alias("route_id"),
        F.col("trip.direction_id").alias("direction_id"),
        compact_date(F.col("trip.start_date")).alias("start_date"),
        _code(F.col("trip.schedule_relationship"), S.SCHEDULE_RELATIONSHIP).alias(
            "schedule_relationship"
        ),
        F.col("s.stop_sequence").alias("stop_sequence"),
        F.col("s.stop_id").alias("stop_id"),
        epoch_to_ts(F.col("s.arrival.time")).alias("arrival_time"),
        F.col("s.arrival.delay").alias("arrival_delay_s"),
        epoch_to_ts(F.col("s.departure.time")).alias("departure_time"),
        F.col("s.departure.delay").alias("departure_delay_s"),
        "raw_payload_hash",
    )


def service_alert_rows(
    feed_df: DataFrame, agency_id: str = S.DEFAULT_AGENCY_ID, keep_position: bool = False
) -> DataFrame:
    """One row per alert entity.  ``keep_position`` adds the entity's place in its
    message, by which the later of two equal ids wins in the merge."""
    rows = _entities(feed_df, "alert", with_position=True)
    a = "e.alert"
    informed = F.col(f"{a}.informed_entity")
    first_period = F.get(F.col(f"{a}.active_period"), F.lit(0))
    columns = [
        F.col("e.id").alias("alert_id"),
        F.lit(agency_id).alias("agency_id"),
        F.col("received_at").alias("first_seen_at"),
        F.col("received_at").alias("last_seen_at"),
        F.col("feed_timestamp"),
        _code(F.col(f"{a}.cause"), S.ALERT_CAUSE).alias("cause"),
        _code(F.col(f"{a}.effect"), S.ALERT_EFFECT).alias("effect"),
        _code(F.col(f"{a}.severity_level"), S.ALERT_SEVERITY).alias("severity_level"),
        english_text(F.col(f"{a}.header_text.translation")).alias("header_text"),
        english_text(F.col(f"{a}.description_text.translation")).alias("description_text"),
        sorted_set(F.transform(informed, lambda i: i["route_id"])).alias("affected_routes"),
        sorted_set(F.transform(informed, lambda i: i["stop_id"])).alias("affected_stops"),
        sorted_set(F.transform(informed, lambda i: i["trip"]["trip_id"])).alias(
            "affected_trips"
        ),
        epoch_to_ts(first_period["start"]).alias("active_period_start"),
        epoch_to_ts(first_period["end"]).alias("active_period_end"),
        F.col("raw_payload_hash"),
    ]
    if keep_position:
        columns.append(F.col("position"))
    return rows.select(*columns)


def split_on_key(rows: DataFrame, key: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key columns are all set, and the rest, which belong in the dead letters
    because a keyed table cannot hold them."""
    whole = F.lit(True)
    for c in key:
        whole = whole & F.col(c).isNotNull()
    return rows.filter(whole), rows.filter(~whole)
