"""Binary feed payloads to the JSON form that the rest of the package reads.

The message layout below is the used part of the public feed specification; fields outside
it are skipped by the protobuf runtime.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopclock.functions.text import sha256
from stopclock.sources.feeds import flag_bad_payloads, parse_feed_json

PACKAGE = "transit_realtime"

# Field numbers and types of the public feed specification, written as
# "number name type"; a trailing * means repeated, a capital a message of this table.
MESSAGES = {
    "FeedMessage": "1 header FeedHeader, 2 entity FeedEntity*",
    "FeedHeader": "1 gtfs_realtime_version string, 2 incrementality int32, 3 timestamp uint64",
    "FeedEntity": "1 id string, 2 is_deleted bool, 3 trip_update TripUpdate, "
    "4 vehicle VehiclePosition, 5 alert Alert",
    "TripUpdate": "1 trip TripDescriptor, 2 stop_time_update StopTimeUpdate*, "
    "3 vehicle VehicleDescriptor, 4 timestamp uint64, 5 delay int32",
    "StopTimeUpdate": "1 stop_sequence uint32, 2 arrival StopTimeEvent, "
    "3 departure StopTimeEvent, 4 stop_id string, 5 schedule_relationship int32",
    "StopTimeEvent": "1 delay int32, 2 time int64, 3 uncertainty int32",
    "VehiclePosition": "1 trip TripDescriptor, 2 position Position, "
    "3 current_stop_sequence uint32, 4 current_status int32, 5 timestamp uint64, "
    "6 congestion_level int32, 7 stop_id string, 8 vehicle VehicleDescriptor, "
    "9 occupancy_status int32",
    "Position": "1 latitude float, 2 longitude float, 3 bearing float, 4 odometer double, "
    "5 speed float",
    "TripDescriptor": "1 trip_id string, 2 start_time string, 3 start_date string, "
    "4 schedule_relationship int32, 5 route_id string, 6 direction_id uint32",
    "VehicleDescriptor": "1 id string, 2 label string, 3 license_plate string",
    "Alert": "1 active_period TimeRange*, 5 informed_entity EntitySelector*, 6 cause int32, "
    "7 effect int32, 8 url TranslatedString, 10 header_text TranslatedString, "
    "11 description_text TranslatedString, 14 severity_level int32",
    "TimeRange": "1 start uint64, 2 end uint64",
    "EntitySelector": "1 agency_id string, 2 route_id string, 3 route_type int32, "
    "4 trip TripDescriptor, 5 stop_id string, 6 direction_id uint32",
    "TranslatedString": "1 translation Translation*",
    "Translation": "1 text string, 2 language string",
}


@cache
def message_class():
    """The feed message class, built from the table above, once in a process: workers serve
    many tasks, and the runtime keeps what it has built."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    field = descriptor_pb2.FieldDescriptorProto
    file = descriptor_pb2.FileDescriptorProto(
        name="feed.proto", package=PACKAGE, syntax="proto2"
    )
    for name, fields in MESSAGES.items():
        message = file.message_type.add(name=name)
        for line in fields.split(","):
            number, label, kind = line.split()
            repeated = kind.endswith("*")
            kind = kind.rstrip("*")
            added = message.field.add(
                name=label,
                number=int(number),
                label=field.LABEL_REPEATED if repeated else field.LABEL_OPTIONAL,
            )
            if kind in MESSAGES:
                added.type = field.TYPE_MESSAGE
                added.type_name = f".{PACKAGE}.{kind}"
            else:
                added.type = getattr(field, f"TYPE_{kind.upper()}")
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(
        pool.FindMessageTypeByName(f"{PACKAGE}.FeedMessage")
    )


_DECODED = T.StructType().add("json", T.StringType()).add("error", T.StringType())


def _to_json(chunks: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    from google.protobuf.json_format import MessageToDict
    from google.protobuf.message import DecodeError

    feed = message_class()

    def decode(payload: bytes | None) -> tuple[str | None, str | None]:
        try:
            message = feed.FromString(payload or b"")
        except DecodeError as e:
            return None, str(e) or "not a feed message"
        return json.dumps(MessageToDict(message, preserving_proto_field_name=True)), None

    for chunk in chunks:
        yield pd.DataFrame([decode(p) for p in chunk], columns=["json", "error"])


def decode_feed_payloads(binary_df: DataFrame) -> DataFrame:
    """Adds header, entity, payload_hash and reject_reason to rows with a binary
    ``content``; the hash is that of the bytes as received, and ``decode_error`` is what the
    decoder said of a payload it refused.

    Payloads are decoded in the tasks that hold them, one at a time.
    """
    decoded = F.pandas_udf(_to_json, _DECODED)
    flagged = flag_bad_payloads(
        binary_df.withColumn("payload_hash", sha256(F.col("content"))), "feed"
    )
    as_json = flagged.withColumn(
        "_d", F.when(F.col("reject_reason").isNull(), decoded("content"))
    )
    parsed = parse_feed_json(
        as_json.withColumnsRenamed({"content": "_raw"})
        .withColumn("content", F.col("_d.json"))
        .withColumn(
            "reject_reason",
            F.coalesce("reject_reason", F.when(F.col("_d.error").isNotNull(), "not_a_feed")),
        )
    )
    parsed = parsed.withColumn("decode_error", F.col("_d.error"))
    return parsed.drop("content", "_d").withColumnRenamed("_raw", "content")
