"""Live delay state: one entry per service day, trip and stop, frozen on arrival."""

from __future__ import annotations

import json
import pickle
from collections import namedtuple
from collections.abc import Iterator
from datetime import date

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stopclock.functions.times import nearest_service_day
from stopclock.operators.delay import STOPPED_AT, schedule_delay
from stopclock.schemas import STOP_DELAY

PREDICTION, POSITION = "prediction", "position"

REPORT_DDL = (
    "start_date date, trip_id string, kind string, received_at timestamp, "
    "stop_sequence int, route_id string, stop_id string, scheduled_at timestamp, "
    "arrival_at timestamp, delay_s int, current_status int"
)
#: Groups that the trips are dealt over; each has one value of state.
GROUPS = 2048
# The workers that use this have no session to read type text with.
_TRIP_STATE = T.StructType().add("state", T.BinaryType())
_TIMES = ("scheduled_at", "arrival_at", "updated_at")
#: What a report is packed with.
_REPORT = (
    "start_date", "trip_id", "kind", "stop_sequence", "route_id", "stop_id", "delay_s", "current_status",
    "received_us", "scheduled_us", "arrival_us",
)
Report = namedtuple("Report", _REPORT)
#: The time of a report without one.
_NEVER = -9223372036854776


def delay_reports(
    trip_updates: DataFrame, positions: DataFrame, stop_times: DataFrame, zone: Column | str
) -> DataFrame:
    """Predictions and positions as one stream of reports per service day and trip.

    The schedule is a static table; a prediction gets its delay here, once, against the
    schedule of the moment.
    """
    zone_c = F.lit(zone) if isinstance(zone, str) else zone
    names = [f.name for f in T.StructType.fromDDL(REPORT_DDL)]
    predicted = schedule_delay(trip_updates, stop_times, zone_c, newest_only=False)
    predicted = predicted.withColumn("kind", F.lit(PREDICTION)).withColumn(
        "current_status", F.lit(None).cast("int")
    )
    schedule = stop_times.filter(F.col("arrival_s").isNotNull()).select(
        "trip_id", F.col("stop_sequence"), F.col("arrival_s").alias("sched_s")
    )
    seen = (
        positions.filter(F.col("trip_id").isNotNull())
        .select(
            "trip_id",
            F.col("current_stop_sequence").alias("stop_sequence"),
            "received_at",
            F.col("current_status").cast("int").alias("current_status"),
        )
        .join(schedule, ["trip_id", "stop_sequence"])
        .withColumn(
            "start_date", nearest_service_day(F.col("received_at"), F.col("sched_s"), zone_c)
        )
        .withColumn("kind", F.lit(POSITION))
    )
    for name, kind in (
        ("route_id", "string"),
        ("stop_id", "string"),
        ("scheduled_at", "timestamp"),
        ("arrival_at", "timestamp"),
        ("delay_s", "int"),
    ):
        seen = seen.withColumn(name, F.lit(None).cast(kind))
    return predicted.select(*names).unionByName(seen.select(*names))


class DelayState(StatefulProcessor):
    """State of one trip on one service day.

    A trip has few stops, so its state and the reports of a micro-batch are small.  The
    timer runs out ``sweep_minutes`` of event time after the last report.  The state is one
    value, read once and written once a micro-batch: when the trip was last heard of, which
    names its timer, the visits by stop (route, stop, scheduled, arrival, delay, status,
    updated) and the sightings by stop (first seen, first stopped).  Reports carry their times
    in microseconds as well.
    """

    def __init__(self, sweep_minutes: float = 30):
        self.sweep_us = int(sweep_minutes * 60_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.trip = handle.getValueState("trip", _TRIP_STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues):
        kept: dict[tuple, tuple[tuple, Row]] = {}
        for r in rows:
            _keep(kept, r)
        before, visits, seen = self._state()
        heard, changed = _advance(before, visits, seen, kept)
        self.trip.update((pickle.dumps((heard, visits, seen), protocol=5),))
        if heard != before:
            if before is not None:
                self.handle.deleteTimer((before + self.sweep_us) // 1000)
            self.handle.registerTimer((heard + self.sweep_us) // 1000)
        yield from _out(key, {s: visits[s] for s in changed})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        _, visits, _ = self._state()
        self.trip.clear()
        yield from _out(key, _abandoned(visits))

    def _state(self) -> tuple[int | None, dict[int, list], dict[int, list]]:
        held = self.trip.get()
        return pickle.loads(held[0]) if held else (None, {}, {})

    def close(self) -> None:
        pass


class GroupedDelayState(StatefulProcessor):
    """State of a group of trips, the form that ``live_delays`` uses.

    A call to the state costs far more than a report does, so all trips of a group share one
    value and one timer, that of the trip which runs out first.  A trip has the same state as
    in ``DelayState``, and is unpacked only when it is reported or runs out.  A row has its
    report packed in one text, since Spark hands rows over cell by cell.
    """

    def __init__(self, sweep_minutes: float = 30):
        self.sweep_us = int(sweep_minutes * 60_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.trips = handle.getValueState("trips", _TRIP_STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues):
        reported: dict[tuple, dict] = {}
        for row in rows:
            r = _unpacked(row.report)
            _keep(reported.setdefault((r.start_date, r.trip_id), {}), r)
        timer, held = self._state()
        out = []
        for trip, kept in reported.items():
            before, packed = held.get(trip, (None, None))
            visits, seen = pickle.loads(packed) if packed else ({}, {})
            heard, changed = _advance(before, visits, seen, kept)
            held[trip] = heard, pickle.dumps((visits, seen), protocol=5)
            out += _out(trip, {s: visits[s] for s in changed})
        self._hold(held, timer)
        yield from out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # Timers before the watermark have run out, and the one that fired.
        end = max(timerValues.getCurrentWatermarkInMs() - 1, expiredTimerInfo.getExpiryTimeInMs())
        _, held = self._state()
        out = []
        for trip in [t for t, (heard, _) in held.items() if self._ends(heard) <= end]:
            visits, _ = pickle.loads(held.pop(trip)[1])
            out += _out(trip, _abandoned(visits))
        self._hold(held, None)  # Spark removes the timer that fired
        yield from out

    def _ends(self, heard: int) -> int:
        return (heard + self.sweep_us) // 1000

    def _state(self) -> tuple[int | None, dict[tuple, tuple[int, bytes]]]:
        held = self.trips.get()
        return pickle.loads(held[0]) if held else (None, {})

    def _hold(self, held: dict[tuple, tuple[int, bytes]], timer: int | None) -> None:
        """Keep the trips, and move the timer, where one is set, to the first that runs out."""
        if not held:
            self.trips.clear()
            return
        first = self._ends(min(heard for heard, _ in held.values()))
        self.trips.update((pickle.dumps((first, held), protocol=5),))
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(first)

    def close(self) -> None:
        pass


def _unpacked(packed: str) -> Report:
    values = json.loads(packed)
    r = Report(*map(values.get, _REPORT))
    return r._replace(start_date=date.fromisoformat(r.start_date)) if r.start_date else r


def _turn(report: Row | Report) -> tuple:
    at = report.received_us
    return at is None, at or 0, report.kind == POSITION, report.stop_sequence


def _keep(kept: dict[tuple, tuple[tuple, Row]], r: Row) -> None:
    """One report of a trip per kind, stop, time and status, that of the latest arrival, so that
    what is held grows with the polls of a micro-batch and not with repeated rows."""
    one = r.kind, r.stop_sequence, r.received_us, r.current_status
    rank = r.arrival_us is not None, r.arrival_us or 0, r.route_id or "", r.stop_id or ""
    if one not in kept or kept[one][0] < rank:
        kept[one] = rank, r


def _advance(
    before: int | None, visits: dict[int, list], seen: dict[int, list], kept: dict[tuple, tuple[tuple, Row]]
) -> tuple[int, list[int]]:
    """Apply a trip's reports to its visits and sightings; returns when it was last heard of and
    the stops that changed."""
    heard = before or 0
    changed = set()
    # Predictions before positions of the same moment: they were still in time.
    for r in sorted((r for _, r in kept.values()), key=_turn):
        now, stop = _NEVER if r.received_us is None else r.received_us, r.stop_sequence
        heard = max(heard, now)
        if r.kind == POSITION:
            first = seen.setdefault(stop, [now, None])
            first[0] = min(first[0], now)
            if r.current_status == STOPPED_AT:
                first[1] = now if first[1] is None else min(first[1], now)
            for s, v in visits.items():
                over = s < stop or (s == stop and r.current_status == STOPPED_AT)
                if over and v[5] != "final":
                    v[5], v[6] = "final", now
                    changed.add(s)
            continue
        over_at = _over_at(stop, seen)
        if over_at is not None and over_at < now:
            continue  # late: the vehicle has been there
        visits[stop] = [
            r.route_id,
            r.stop_id,
            r.scheduled_us,
            r.arrival_us,
            r.delay_s,
            "predicted" if over_at is None else "final",
            now,
        ]
        changed.add(stop)
    return heard, sorted(changed)


def _abandoned(visits: dict[int, list]) -> dict[int, list]:
    return {s: [*v[:5], "abandoned", v[6]] for s, v in visits.items() if v[5] == "predicted"}


def _over_at(stop: int, seen: dict[int, list]) -> int | None:
    """When the vehicle stopped at ``stop`` or was first seen beyond it."""
    times = [v[0] for s, v in seen.items() if s > stop]
    if stop in seen and seen[stop][1] is not None:
        times.append(seen[stop][1])
    return min(times, default=None)


def _out(key, visits: dict[int, list]) -> Iterator[Row]:
    for stop, v in visits.items():
        yield Row(
            start_date=key[0],
            trip_id=key[1],
            stop_sequence=stop,
            route_id=v[0],
            stop_id=v[1],
            scheduled_at=v[2],
            arrival_at=v[3],
            delay_s=v[4],
            status=v[5],
            updated_at=v[6],
        )


def live_delays(
    reports: DataFrame, sweep_minutes: float = 30, lateness: str = "5 minutes"
) -> DataFrame:
    """Stream of changed stop delays out of a stream of reports; needs the RocksDB state
    store and update output mode."""
    group = F.pmod(F.xxhash64("start_date", "trip_id"), F.lit(GROUPS)).cast("int")
    timed = reports.withWatermark("received_at", lateness).withColumns(
        {f"{c}_us": F.unix_micros(f"{c}_at") for c in ("received", "scheduled", "arrival")}
    )
    packed = F.to_json(F.struct(*_REPORT), {"dateFormat": "yyyy-MM-dd"})
    timed = timed.select(group.alias("trips"), packed.alias("report"), "received_at")
    in_us = T.StructType(
        [T.StructField(f.name, T.LongType()) if f.name in _TIMES else f for f in STOP_DELAY.schema]
    )
    changes = timed.groupBy("trips").transformWithState(
        statefulProcessor=GroupedDelayState(sweep_minutes),
        outputStructType=in_us,
        outputMode="Update",
        timeMode="EventTime",
    )
    return changes.withColumns({c: F.timestamp_micros(c) for c in _TIMES}).select(*STOP_DELAY.columns)
