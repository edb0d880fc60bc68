"""Avro definitions the workload ingests."""

from __future__ import annotations

import json

from tollgate.plans.revisions import make_revision

_ISO = {"type": "string", "logicalType": "iso-datetime"}


def _record(name: str, fields: list[dict]) -> str:
    return json.dumps({"type": "record", "name": name, "fields": fields})


# Fields of a ride message, first and second revision.
RIDE_V1_FIELDS = [
    {"name": "ride_id", "type": "string"},
    {"name": "point_idx", "type": "int"},
    {"name": "latitude", "type": "double"},
    {"name": "longitude", "type": "double"},
    {"name": "timestamp", "type": _ISO},
    {"name": "meter_reading", "type": "double"},
    {"name": "meter_increment", "type": "double"},
    {"name": "ride_status", "type": "string"},
    {"name": "passenger_count", "type": "int"},
]
RIDE_V2_FIELDS = [
    *RIDE_V1_FIELDS,
    {"name": "enrichment_timestamp", "type": ["null", _ISO], "default": None},
    {"name": "region", "type": ["null", "string"], "default": None},
]

RIDE_V1 = _record("Ride", RIDE_V1_FIELDS)
RIDE_V2 = _record("Ride", RIDE_V2_FIELDS)

SCHEMA_NAME = "rides"
REVISION_1 = make_revision(SCHEMA_NAME, 1, RIDE_V1)
REVISION_2 = make_revision(SCHEMA_NAME, 2, RIDE_V2)

EPOCH_MILLIS = _record(
    "EpochMillis",
    [
        {"name": "event_id", "type": "long"},
        {"name": "ts", "type": {"type": "long", "logicalType": "timestamp-millis"}},
    ],
)
EPOCH_MICROS = _record(
    "EpochMicros",
    [
        {"name": "event_id", "type": "long"},
        {"name": "ts", "type": {"type": "long", "logicalType": "timestamp-micros"}},
    ],
)
ORDER = _record(
    "Order",
    [
        {"name": "order_key", "type": "long"},
        {"name": "order_date", "type": {"type": "int", "logicalType": "date"}},
        {"name": "time_millis", "type": {"type": "int", "logicalType": "time-millis"}},
        {"name": "time_micros", "type": {"type": "long", "logicalType": "time-micros"}},
        {"name": "is_open", "type": "boolean"},
        {"name": "total_price", "type": "float"},
        {"name": "priority", "type": "bytes"},
    ],
)
