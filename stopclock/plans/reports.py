"""Whole questions from stored tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopclock import storage
from stopclock.operators.events import settled
from stopclock.operators.freshness import freshness
from stopclock.operators.headway import collapse_arrivals, headways, route_reliability
from stopclock.plans.buckets import read_buckets
from stopclock.plans.tables import append_events, read_events, table_path
from stopclock.schemas import (
    DEFAULT_AGENCY_ID,
    EVENT_TABLES,
    FRESHNESS,
    SERVICE_ALERTS,
    Table,
)


def route_reliability_report(
    trip_updates: DataFrame,
    as_of: Column | datetime | str | None = None,
    min_gaps: int = 30,
    per_day: bool = False,
) -> DataFrame:
    """Trip updates to one line per route and direction.  With ``as_of``, rows younger than
    a minute before it are left out."""
    if as_of is not None:
        trip_updates = settled(trip_updates, as_of)
    return route_reliability(headways(collapse_arrivals(trip_updates, per_day)), min_gaps)


def stored_freshness(
    spark: SparkSession,
    root: str,
    table: Table,
    feed_key: str,
    as_of: datetime,
    agency_id: str = DEFAULT_AGENCY_ID,
) -> DataFrame:
    """Freshness of a stored event table.

    Reads the days of the last hour and the newest day before; only while those hold no row
    of the agency, further days backwards, each step twice as many as the one before.
    """
    events = read_events(spark, root, table)
    days = [d for d in storage.day_folders(spark, table_path(root, table)) if d <= as_of.date()]
    hour_ago = (as_of - timedelta(hours=1)).date()
    end, step = as_of.date(), 1
    first = min([*days[-1:], hour_ago])
    while True:
        span = F.col("dt").between(F.lit(first), F.lit(end))
        row = freshness(events.filter(span), feed_key, as_of, agency_id=agency_id)
        days = [d for d in days if d < first]
        if not days or row.first()["last_record_at"] is not None:
            return row
        end, step = days[-1], step * 2
        first = days[max(0, len(days) - step)]


def record_freshness(
    spark: SparkSession, root: str, as_of: datetime, agency_id: str = DEFAULT_AGENCY_ID
) -> DataFrame:
    """Check all feeds of a store, append the snapshots to its history, and return them.

    The alert feed counts alerts that were still in the newest polls, not new ones.
    """
    snapshots = freshness(
        read_buckets(spark, root, SERVICE_ALERTS),
        f"{agency_id}.{SERVICE_ALERTS.name}",
        as_of,
        ts_col="last_seen_at",
        agency_id=agency_id,
    )
    for table in EVENT_TABLES.values():
        feed_key = f"{agency_id}.{table.name}"
        snapshots = snapshots.unionByName(
            stored_freshness(spark, root, table, feed_key, as_of, agency_id)
        )
    append_events(spark, root, FRESHNESS, snapshots, ts_col="snapshot_at")
    return snapshots
