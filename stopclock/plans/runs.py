"""The run log: one row per landed batch, also where it fails."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from stopclock.plans.tables import append_all
from stopclock.schemas import RUNS

MESSAGE_CHARS = 2000


@dataclass
class Run:
    """What a job fills in while it runs."""

    records_written: int | None = None
    bytes_processed: int | None = None


@contextmanager
def logged_run(spark: SparkSession, root: str, asset_key: str, token: str | None = None) -> Iterator[Run]:
    """Write a row to the run log when the block ends; an error is noted and goes on.

    Every attempt at a batch is a run of its own.
    """
    run, started = Run(), datetime.now(timezone.utc)
    failure: BaseException | None = None
    try:
        yield run
    except BaseException as e:
        failure = e
        raise
    finally:
        row = (
            f"{token or 'batch'}.{uuid.uuid4().hex[:12]}",
            asset_key,
            started,
            datetime.now(timezone.utc),
            "failure" if failure else "success",
            run.records_written,
            run.bytes_processed,
            type(failure).__name__ if failure else None,
            str(failure)[:MESSAGE_CHARS] if failure else None,
        )
        append_all(spark.createDataFrame([row], RUNS.ddl), root, RUNS, ts_col="started_at")
