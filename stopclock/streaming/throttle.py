"""Throttle: the first so many events per key in a window that starts with the key's first
event, and restarts with the first event after it has run out.

``throttle`` is the stream, ``throttle_batch`` the same for rows at rest.  An event without a
time is not allowed and counts for nothing.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from itertools import groupby, islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Events of one key that are held in one piece, in whatever slices they are.
PIECE_ROWS = 4096

_WINDOW = T.StructType().add("start_us", T.LongType()).add("used", T.IntegerType())
_PIECE_KEY = T.StructType().add("slice", T.LongType()).add("piece", T.StringType())
_PIECE = T.StructType().add("rows", T.BinaryType())


def _allowed(
    times_us: list[int], start: int | None, used: int, limit: int, window_us: int
) -> tuple[list[bool], int | None, int]:
    """Which of one key's events, in order of time, pass; and the window they leave."""
    out = []
    for now in times_us:
        if start is None or now - start >= window_us:
            start, used = now, 0
        out.append(used < limit)
        used = min(used + 1, limit)
    return out, start, used


def _micros(times: pd.Series) -> pd.Series:
    return times.astype("datetime64[us]").astype("int64")


class FixedWindow(StatefulProcessor):
    """Holds a key's events back until the watermark has passed them, then counts them.

    Events are kept in pieces, named after the slice of time of their first event; a piece's
    timer fires when no event of that slice can come any more.  It counts all slices that the
    watermark has passed, in order of time whatever the order in which events came.  The
    events of a micro-batch are one piece where they are few and are cut by slices where they
    are many, so of a busy key one slice is in memory at a time, and of a quiet one neither
    state calls nor timers grow with the slices.  With nothing held back, the key's state goes
    with its window.

    A row is (time in microseconds, other columns), a piece a pickled list of rows.
    """

    def __init__(self, limit: int, window_s: float, slice_s: float):
        self.limit = limit
        self.window_us, self.slice_us = int(window_s * 1_000_000), max(1_000, int(slice_s * 1_000_000))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", _WINDOW)
        self.held = handle.getMapState("held", _PIECE_KEY, _PIECE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues):
        first = None
        chunk = _chunk(rows)
        whole = len(chunk) < PIECE_ROWS
        while chunk:
            timeless = [r for r in chunk if r[0] is None]
            if timeless:
                yield _packed(timeless, [False] * len(timeless))
            timed = [r for r in chunk if r[0] is not None]
            if timed:
                number = self._hold(timed, whole)
                first = number if first is None else min(first, number)
            chunk = _chunk(rows)
        if first is not None:
            self._wake(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now_us = timerValues.getCurrentWatermarkInMs() * 1000
        passed = now_us // self.slice_us  # slices before this one are complete
        keys = sorted(self.held.keys())
        due = [k for k in keys if k[0] < passed]
        start, used = self.window.get() or (None, 0)
        rows = []
        for number, pieces in groupby(due, key=lambda k: k[0]):
            # No event of an earlier slice is in this piece or a later one.
            ready, rows = _split(rows, number * self.slice_us)
            if ready:
                out, start, used = self._counted(ready, start, used)
                yield out
            for k in pieces:
                rows += pickle.loads(self.held.getValue(k)[0])
                if len(due) < len(keys):
                    self.held.removeKey(k)
        if due and len(due) == len(keys):
            self.held.clear()
        ready, rows = _split(rows, passed * self.slice_us)
        if ready:
            out, start, used = self._counted(ready, start, used)
            yield out
        waiting = [k[0] for k in keys[len(due) :]]
        if rows:
            waiting.append(self._hold(rows, len(rows) < PIECE_ROWS))
        if due and waiting:
            self._wake(min(waiting))
        if start is None:
            return
        if not waiting and start + self.window_us <= now_us:
            self.window.clear()  # no event of it is held back or can still come
        elif due:
            self.window.update((int(start), int(used)))
            if not waiting:
                self.handle.registerTimer(-(-(start + self.window_us) // 1000))

    def _hold(self, rows: list[tuple], whole: bool) -> int:
        """Keep rows back, as one piece or cut by slices; returns their first slice."""
        rows.sort(key=_time)
        first = rows[0][0] // self.slice_us
        parts = [(first, rows)] if whole else groupby(rows, key=lambda r: r[0] // self.slice_us)
        for number, part in parts:
            self.held.updateValue((number, uuid.uuid4().hex), (pickle.dumps(list(part), protocol=5),))
        return first

    def _wake(self, number: int) -> None:
        """Set the timer of a slice."""
        self.handle.registerTimer(-(-(number + 1) * self.slice_us // 1000))

    def _counted(self, rows: list[tuple], start: int | None, used: int) -> tuple[Row, int | None, int]:
        rows.sort(key=_time)
        allowed, start, used = _allowed([r[0] for r in rows], start, used, self.limit, self.window_us)
        return _packed(rows, allowed), start, used

    def close(self) -> None:
        pass


def _time(row: tuple) -> int:
    return row[0]


def _chunk(rows: Iterator[Row]) -> list[tuple]:
    # The last column is the time as a timestamp, which only the watermark needs.
    return [tuple(r)[:-1] for r in islice(rows, PIECE_ROWS)]


def _split(rows: list[tuple], end_us: int) -> tuple[list[tuple], list[tuple]]:
    """Rows before a time and the others."""
    return [r for r in rows if r[0] < end_us], [r for r in rows if r[0] >= end_us]


def _packed(rows: list[tuple], allowed: list[bool]) -> Row:
    return Row(rows=pickle.dumps([(*r, a) for r, a in zip(rows, allowed, strict=True)], protocol=5))


def _unpacked(arrow: pa.Schema):
    """Packed rows to rows of the schema."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for packed in batch.column("rows"):
                rows += pickle.loads(packed.as_py())
                if len(rows) >= PIECE_ROWS:
                    yield _record(rows, arrow)
                    rows = []
            if rows:
                yield _record(rows, arrow)

    return run


def _record(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=arrow)


def throttle(
    events: DataFrame,
    key: str,
    ts_col: str,
    limit: int = 60,
    window_s: float = 60,
    lateness: str = "1 minute",
    slice_s: float | None = None,
) -> DataFrame:
    """Stream of the events with a column ``allowed``, each released once the watermark,
    ``lateness`` behind the newest event, has passed its slice of ``slice_s`` (a window's
    length where not given).

    Events may come in any order within the lateness; later ones fall out of the stream and
    are counted by ``dropped_rows``.  Needs the RocksDB state store.
    """
    names = events.columns
    others = [c for c in names if c != ts_col]
    timed = events.withWatermark(ts_col, lateness)
    timed = timed.select(F.unix_micros(ts_col).alias("_us"), *others, ts_col)
    kinds = {f.name: f.dataType for f in events.schema}
    fields = [T.StructField(c, kinds[c]) for c in others]
    out = T.StructType(
        [T.StructField("_us", T.LongType()), *fields, T.StructField("allowed", T.BooleanType())]
    )
    packed = timed.groupBy(key).transformWithState(
        statefulProcessor=FixedWindow(limit, window_s, slice_s or window_s),
        outputStructType=T.StructType().add("rows", T.BinaryType()),
        outputMode="Append",
        timeMode="EventTime",
    )
    arrow = events.sparkSession.createDataFrame([], out).toArrow().schema
    rows = packed.mapInArrow(_unpacked(arrow), out).withColumn(ts_col, F.timestamp_micros("_us"))
    return rows.select(*names, "allowed")


def throttle_batch(
    events: DataFrame, key: str, ts_col: str, limit: int = 60, window_s: float = 60
) -> DataFrame:
    """All events with a column ``allowed``.

    Rows are dealt by key and sorted by key and time on disk if need be; one pass over a
    partition then keeps a single window, so a key of any size takes no memory.
    """
    schema = T.StructType([*events.schema.fields, T.StructField("allowed", T.BooleanType())])
    window_us = int(window_s * 1_000_000)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, start, used, begun = None, None, 0, False
        for batch in batches:
            timeless = batch[ts_col].isna().tolist()
            times, passed = _micros(batch[ts_col]).tolist(), []
            keys = batch[key].astype(object).where(batch[key].notna(), None).tolist()
            for value, run_of in groupby(range(len(keys)), key=keys.__getitem__):
                if not begun or value != held:
                    held, start, used, begun = value, None, 0, True
                mine = list(run_of)
                timed = [i for i in mine if not timeless[i]]
                allowed, start, used = _allowed([times[i] for i in timed], start, used, limit, window_us)
                passed += [False] * (len(mine) - len(timed)) + allowed  # null times sort first
            yield batch.assign(allowed=passed)

    ordered = events.repartition(F.col(key)).sortWithinPartitions(key, ts_col)
    return ordered.mapInPandas(run, schema)
