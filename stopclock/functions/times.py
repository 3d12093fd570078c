"""Dates, instants and GTFS times."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from stopclock.functions.text import strip, text_or_null

DAY_US = 86_400_000_000
HALF_DAY_S = 43_200


def instant(value: Column | datetime | str) -> Column:
    """A timestamp column from a column, a datetime or ISO text; without a zone the latter
    two mean UTC, whatever the session's time zone."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = datetime.fromisoformat(value.strip())
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    micros = (value - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros).cast("long"))


def day(value: Column | date | str) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("date")


def minus(ts: Column, *, days: float = 0, hours: float = 0, minutes: float = 0) -> Column:
    """An instant moved back by a fixed length of time."""
    micros = round((days * 86_400 + hours * 3_600 + minutes * 60) * 1_000_000)
    return F.timestamp_micros(F.unix_micros(ts) - F.lit(micros).cast("long"))


def epoch_to_ts(c: Column) -> Column:
    """Epoch seconds, as number or as digits in text, to an instant."""
    return F.timestamp_seconds(c.try_cast("long"))


def ts_to_epoch(c: Column) -> Column:
    """Whole epoch seconds, rounded down."""
    return F.unix_seconds(c)


def elapsed_s(later: Column, earlier: Column) -> Column:
    """Whole seconds between two instants, cut toward zero."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return (micros / F.lit(1_000_000)).cast("long")


def compact_date(c: Column) -> Column:
    """``YYYYMMDD`` to a date, NULL where it is none."""
    return F.try_to_date(F.substring(text_or_null(c), 1, 8), "yyyyMMdd")


def gtfs_seconds(c: Column) -> Column:
    """``HH:MM:SS`` to seconds; hours may pass 24."""
    text = strip(c)
    colons = F.length(text) - F.length(F.translate(text, ":", ""))
    hours = F.substring_index(text, ":", 1).try_cast("int")
    minutes = F.substring_index(F.substring_index(text, ":", 2), ":", -1).try_cast("int")
    seconds = F.substring_index(text, ":", -1).try_cast("int")
    return F.when(colons == 2, hours * 3600 + minutes * 60 + seconds)


def seconds_to_interval(seconds: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def gtfs_interval(c: Column) -> Column:
    """``HH:MM:SS`` to an interval; hours may pass 24."""
    return seconds_to_interval(gtfs_seconds(c))


def service_noon_epoch(service_day: Column, zone: Column) -> Column:
    """Epoch seconds of local noon minus twelve hours, the zero of GTFS times."""
    noon = F.make_timestamp(
        F.year(service_day),
        F.month(service_day),
        F.day(service_day),
        F.lit(12),
        F.lit(0),
        F.lit(0),
        zone,
    )
    return F.unix_seconds(noon) - HALF_DAY_S


def scheduled_at(service_day: Column, seconds: Column, zone: Column) -> Column:
    """Instant of a GTFS time on a service day in the agency's zone."""
    return F.timestamp_seconds(service_noon_epoch(service_day, zone) + seconds)


def nearest_service_day(observed: Column, seconds: Column, zone: Column) -> Column:
    """The service day on which the scheduled time lies closest to ``observed`` (the
    earlier day on a tie)."""
    # A GTFS time may pass 24 hours by far: the day is sought around its own start.
    base = utc_day(F.timestamp_micros(F.unix_micros(observed) - seconds.cast("long") * 1_000_000))

    def candidate(offset: int) -> Column:
        d = F.date_add(base, offset)
        gap = F.abs(F.unix_seconds(observed) - (service_noon_epoch(d, zone) + seconds))
        return F.struct(gap.alias("gap"), d.alias("day"))

    return F.array_min(F.array(candidate(-1), candidate(0), candidate(1)))["day"]


def utc_day(c: Column | str) -> Column:
    """The UTC day of an instant, whatever the session's time zone."""
    micros = F.unix_micros(F.col(c) if isinstance(c, str) else c)
    days = (micros - F.pmod(micros, F.lit(DAY_US))) / DAY_US
    return F.date_from_unix_date(days.cast("int"))


def wall_hour(c: Column | str, zone: Column) -> Column:
    """The hour on a zone's clock at an instant, whatever the session's time zone."""
    shifted = F.unix_micros(F.from_utc_timestamp(c, zone))
    return F.floor(F.pmod(shifted, F.lit(DAY_US)) / 3_600_000_000).cast("int")


def day_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")
