"""Schedule delay: predicted arrivals against the schedule, frozen when the vehicle arrives."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopclock import schemas as S
from stopclock.functions.times import instant, minus, nearest_service_day, scheduled_at, wall_hour
from stopclock.operators.events import latest_per_key

VISIT = ["start_date", "trip_id", "stop_sequence"]
STOPPED_AT = S.VEHICLE_STOP_STATUS["STOPPED_AT"]
#: Repeated reports of one stop collapse inside slices of so many seconds: far less than the
#: day that lies between two runs of a trip, wherever the UTC midnight falls.
SLICE_S = 4 * 3600


def with_agency_zone(rows: DataFrame, agency: DataFrame, zone_col: str = "agency_zone") -> DataFrame:
    """``rows`` with the time zone of their agency, NULL for an unknown one.

    The agency side has one row per agency.  Spark broadcasts it if it is small; beyond that
    the join is split where one agency owns most rows.
    """
    zones = agency.groupBy("agency_id").agg(F.min("agency_timezone").alias(zone_col))
    return rows.join(zones, "agency_id", "left")


def _slice(ts_col: str) -> Column:
    return F.floor(F.unix_seconds(ts_col) / SLICE_S)


def _schedule(stop_times: DataFrame) -> DataFrame:
    return stop_times.filter(F.col("arrival_s").isNotNull()).select(
        "trip_id", "stop_sequence", F.col("arrival_s").alias("sched_s")
    )


def schedule_delay(
    trip_updates: DataFrame,
    stop_times: DataFrame,
    zone: Column | str,
    newest_only: bool = True,
) -> DataFrame:
    """Predictions with their scheduled instant and delay in seconds.

    Where the feed gives no service day, the one that makes the delay smallest is taken
    and ``day_inferred`` is true.  ``newest_only`` keeps the last received prediction per
    service day, trip and stop; superseded ones are dropped before the join as well.
    """
    zone = F.lit(zone) if isinstance(zone, str) else zone
    newest = [F.col("received_at").desc(), F.col("arrival_time").desc()]
    usable = trip_updates.filter(
        F.col("arrival_time").isNotNull()
        & F.col("trip_id").isNotNull()
        & F.col("stop_sequence").isNotNull()
    ).select(*VISIT, "agency_id", "route_id", "stop_id", "arrival_time", "received_at")
    if newest_only:
        about = F.when(F.col("start_date").isNull(), _slice("arrival_time"))
        usable = latest_per_key(
            usable.withColumn("_about", about),
            ["start_date", "_about", "trip_id", "stop_sequence"],
            newest,
        ).drop("_about")
    timed = (
        usable.join(_schedule(stop_times), ["trip_id", "stop_sequence"])
        .withColumn("day_inferred", F.col("start_date").isNull())
        .withColumn(
            "start_date",
            F.coalesce("start_date", nearest_service_day(F.col("arrival_time"), F.col("sched_s"), zone)),
        )
        .withColumn("scheduled_at", scheduled_at(F.col("start_date"), F.col("sched_s"), zone))
    )
    delayed = timed.select(
        *VISIT,
        "route_id",
        "stop_id",
        "scheduled_at",
        F.col("arrival_time").alias("arrival_at"),
        (F.unix_seconds("arrival_time") - F.unix_seconds("scheduled_at"))
        .cast("int")
        .alias("delay_s"),
        "day_inferred",
        "received_at",
    )
    if newest_only:
        newest = [F.col("received_at").desc(), F.col("arrival_at").desc()]
        delayed = latest_per_key(delayed, VISIT, newest)
    return delayed


def sightings(
    positions: DataFrame, stop_times: DataFrame, zone: Column | str
) -> DataFrame:
    """First and last time a trip's vehicle was seen at each stop sequence, and first time
    stopped there, per service day.

    Positions carry no service day; it is the one on which the schedule of the reported
    stop lies closest.
    """
    zone = F.lit(zone) if isinstance(zone, str) else zone
    seen = positions.filter(
        F.col("trip_id").isNotNull() & F.col("current_stop_sequence").isNotNull()
    )
    # Repeated reports of one stop collapse before the join.
    first = (
        seen.groupBy(
            "agency_id",
            "trip_id",
            _slice("received_at").alias("slice"),
            F.col("current_stop_sequence").alias("stop_sequence"),
        )
        .agg(
            F.min("received_at").alias("seen_at"),
            F.max("received_at").alias("last_at"),
            F.min(F.when(F.col("current_status") == STOPPED_AT, F.col("received_at"))).alias(
                "stopped_at"
            ),
        )
    )
    return (
        first.join(_schedule(stop_times), ["trip_id", "stop_sequence"])
        .withColumn("start_date", nearest_service_day(F.col("seen_at"), F.col("sched_s"), zone))
        .groupBy(*VISIT)
        .agg(
            F.min("seen_at").alias("seen_at"),
            F.max("last_at").alias("last_at"),
            F.min("stopped_at").alias("stopped_at"),
        )
    )


def finalize_times(visits: DataFrame, seen: DataFrame) -> DataFrame:
    """When each visit was over: the vehicle stopped there, or was seen at a later stop;
    and when the trip was last seen anywhere.

    ``visits`` has service day, trip and stop sequence; ``seen`` comes from ``sightings``.
    Both are one row per visit, so a trip is a short list, and a running minimum from its
    last stop backwards answers for all stops at once.
    """
    asked = visits.select(*VISIT).distinct()
    trip = asked.withColumn("asked", F.lit(True)).join(seen, VISIT, "full_outer")
    later = (
        Window.partitionBy("start_date", "trip_id")
        .orderBy(F.col("stop_sequence").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    whole_trip = Window.partitionBy("start_date", "trip_id")
    return (
        trip.withColumn("passed_at", F.min("seen_at").over(later))
        .withColumn("vehicle_last_at", F.max("last_at").over(whole_trip))
        .filter(F.col("asked"))
        .select(
            *VISIT,
            F.least("stopped_at", "passed_at").alias("finalized_at"),
            F.when(F.col("stopped_at") <= F.coalesce("passed_at", "stopped_at"), "stopped")
            .when(F.col("passed_at").isNotNull(), "passed")
            .alias("evidence"),
            "vehicle_last_at",
        )
    )


def stop_delays(
    trip_updates: DataFrame,
    positions: DataFrame,
    stop_times: DataFrame,
    zone: Column | str,
    as_of: Column | datetime | str,
    sweep_minutes: float = 30,
) -> DataFrame:
    """One row per service day, trip and stop: the last prediction before the vehicle
    arrived, as ``final``; still open ones as ``predicted``; and open ones of a trip that
    nothing was heard of for ``sweep_minutes`` as ``abandoned``, with the last known delay."""
    now = instant(as_of)
    predicted = schedule_delay(trip_updates, stop_times, zone, newest_only=False).filter(
        F.col("received_at") <= now
    )
    seen = sightings(positions.filter(F.col("received_at") <= now), stop_times, zone)
    # The stops of every trip seen, from the schedule: the predictions are read once.
    trips = seen.select("start_date", "trip_id").distinct()
    stops = trips.join(_schedule(stop_times).select("trip_id", "stop_sequence"), "trip_id")
    in_time = predicted.join(finalize_times(stops, seen), VISIT, "left").filter(
        F.col("finalized_at").isNull() | (F.col("received_at") <= F.col("finalized_at"))
    )
    last = latest_per_key(
        in_time, VISIT, [F.col("received_at").desc(), F.col("arrival_at").desc()]
    )
    heard = F.max(F.greatest("received_at", "vehicle_last_at")).over(
        Window.partitionBy("start_date", "trip_id")
    )
    status = (
        F.when(F.col("finalized_at").isNotNull(), "final")
        .when(heard < minus(now, minutes=sweep_minutes), "abandoned")
        .otherwise("predicted")
    )
    return last.select(
        *VISIT,
        "route_id",
        "stop_id",
        "scheduled_at",
        "arrival_at",
        "delay_s",
        status.alias("status"),
        F.coalesce("finalized_at", "received_at").alias("updated_at"),
    )


def delay_reliability(
    delays: DataFrame,
    on_time: tuple[int, int] = (-60, 300),
    zone: Column | str = "UTC",
) -> DataFrame:
    """Final delays per route, hour and service day: count, mean, median, 90th percentile
    and the share on time (both bounds included)."""
    early, late = on_time
    zone = F.lit(zone) if isinstance(zone, str) else zone
    hour = wall_hour("scheduled_at", zone)
    quantiles = F.percentile("delay_s", F.array(F.lit(0.5), F.lit(0.9)))
    return (
        delays.filter((F.col("status") == "final") & F.col("delay_s").isNotNull())
        .groupBy("route_id", F.col("start_date").alias("day"), hour.alias("hour"))
        .agg(
            F.count("*").alias("n_visits"),
            F.avg("delay_s").alias("avg_delay_s"),
            quantiles.alias("q"),
            F.avg(F.col("delay_s").between(early, late).cast("int")).alias("on_time_share"),
        )
        .select(
            "route_id",
            "day",
            "hour",
            "n_visits",
            "avg_delay_s",
            F.col("q")[0].alias("median_delay_s"),
            F.col("q")[1].alias("p90_delay_s"),
            "on_time_share",
        )
    )
