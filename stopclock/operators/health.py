"""Runs and feeds: recent runs, success rate, drift."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopclock.functions.times import instant, minus
from stopclock.operators.events import since, until


def recent_runs(runs: DataFrame, limit: int = 50) -> DataFrame:
    """The newest runs."""
    if not 1 <= limit <= 200:
        raise ValueError("limit must be 1..200")
    return (
        runs.orderBy(F.col("started_at").desc(), "run_id")
        .limit(limit)
        .select(
            "run_id", "asset_key", "started_at", "completed_at", "status", "records_written"
        )
    )


def feed_health(
    runs: DataFrame,
    signatures: DataFrame,
    as_of: Column | datetime | str,
    hours: int = 24,
) -> DataFrame:
    """Per feed, over the last hours: runs, share of them that succeeded, and how many
    signatures were seen for the first time.

    The feed key of a run is its asset key.  Runs still going do not count.
    """
    now = instant(as_of)
    start = minus(now, hours=hours)
    ended = until(since(runs, "started_at", start, False), "started_at", now).filter(
        F.col("status") != "running"
    )
    rates = ended.groupBy(F.col("asset_key").alias("feed_key")).agg(
        F.count("*").alias("n_runs"),
        F.count_if(F.col("status") == "success").alias("n_success"),
    )
    fresh = until(
        since(signatures, "first_seen_at", start, False), "first_seen_at", now
    )
    drift = fresh.groupBy("feed_key").agg(F.count("*").alias("n_new_signatures"))
    runs_n, drift_n = F.coalesce("n_runs", F.lit(0)), F.coalesce("n_new_signatures", F.lit(0))
    return rates.join(drift, "feed_key", "full_outer").select(
        "feed_key",
        runs_n.alias("n_runs"),
        (F.col("n_success") / F.col("n_runs")).alias("success_rate"),
        drift_n.alias("n_new_signatures"),
        (drift_n > 0).alias("drifted"),
    )
