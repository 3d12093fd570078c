"""Small feed messages in their JSON form."""

from __future__ import annotations

import json

RECEIVED = "2026-04-14 12:00:00"


def message(*entities: dict, timestamp: int | None = 1_700_000_000) -> dict:
    header = {"gtfs_realtime_version": "2.0"}
    if timestamp is not None:
        header["timestamp"] = str(timestamp)
    return {"header": header, "entity": list(entities)}


def vehicle_full() -> dict:
    return {
        "id": "v1",
        "vehicle": {
            "vehicle": {"id": "1234"},
            "trip": {"trip_id": "T-001", "route_id": "504", "direction_id": 0},
            "position": {
                "latitude": 43.6532, "longitude": -79.3832, "bearing": 90.0, "speed": 12.5,
            },
            "current_status": "IN_TRANSIT_TO",
            "current_stop_sequence": 5,
            "stop_id": "STOP-A",
        },
    }


def trip_update() -> dict:
    return {
        "id": "t1",
        "trip_update": {
            "trip": {"trip_id": "T-001", "route_id": "504", "start_date": "20260414"},
            "stop_time_update": [
                {
                    "stop_sequence": 5,
                    "stop_id": "STOP-A",
                    "arrival": {"time": "1700000300", "delay": 60},
                }
            ],
        },
    }


def alert(text: str = "504 King: detour at Spadina") -> dict:
    return {
        "id": "alert-001",
        "alert": {
            "cause": "MAINTENANCE",
            "effect": "DETOUR",
            "severity_level": "INFO",
            "header_text": {"translation": [{"text": text, "language": "en"}]},
            "informed_entity": [{"route_id": "504"}],
            "active_period": [{"start": "1700000000", "end": "1700010000"}],
        },
    }


def polls(spark, *messages: dict | str, times: tuple[str, ...] = ()):
    """Polls as the file reader gives them."""
    from pyspark.sql import functions as F

    from stopclock.sources.feeds import flag_bad_payloads, parse_feed_json

    rows = [
        (f"poll-{i}", times[i] if times else RECEIVED, m if isinstance(m, str) else json.dumps(m))
        for i, m in enumerate(messages)
    ]
    df = spark.createDataFrame(rows, "path string, received_at string, content string").select(
        "path",
        F.col("received_at").cast("timestamp").alias("received_at"),
        F.col("content").cast("binary").alias("content"),
        F.sha2("content", 256).alias("payload_hash"),
    )
    return parse_feed_json(flag_bad_payloads(df, "feed"))
