"""Fixed schemas: the message and the tables it is written to."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns])


MESSAGE = _struct(
    ("data", BinaryType()),
    ("attributes", MapType(StringType(), StringType())),
    ("message_id", StringType()),
    ("publish_time", TimestampType()),
)

_METADATA = (
    ("subscription_name", StringType()),
    ("message_id", StringType()),
    ("publish_time", TimestampType()),
    ("processing_time", TimestampType()),
)

STANDARD = _struct(
    *_METADATA,
    ("ride_id", StringType()),
    ("point_idx", LongType()),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
    ("timestamp", TimestampType()),
    ("meter_reading", DoubleType()),
    ("meter_increment", DoubleType()),
    ("ride_status", StringType()),
    ("passenger_count", LongType()),
    ("attributes", StringType()),
)

RAW = _struct(*_METADATA, ("attributes", StringType()), ("payload", StringType()))

DEAD_LETTER = _struct(
    ("processing_time", TimestampType()),
    ("error_message", StringType()),
    ("stack_trace", StringType()),
    ("original_payload", StringType()),
    ("subscription_name", StringType()),
)

ENVELOPE = _struct(
    *_METADATA,
    ("attributes", StringType()),
    ("schema_name", StringType()),
    ("schema_revision_id", StringType()),
    ("schema_encoding", StringType()),
)

# Value taken when a key is absent from the payload; an explicit null stays null.
STANDARD_DEFAULTS = {
    "ride_id": "",
    "point_idx": 0,
    "latitude": 0.0,
    "longitude": 0.0,
    "meter_reading": 0.0,
    "meter_increment": 0.0,
    "ride_status": "",
    "passenger_count": 0,
}

# The payload part of STANDARD, in column order.
RIDE_FIELDS = tuple(f for f in STANDARD.fields if f.name in STANDARD_DEFAULTS or f.name == "timestamp")
