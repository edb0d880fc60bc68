"""Avro record definitions turned into column plans."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tollgate.functions import jsonx, timex
from tollgate.model import ENVELOPE

# Avro primitive -> (column type, its name in a schema string, JSON kind).
PRIMITIVES = {
    "string": (StringType(), "STRING", "string"),
    "int": (LongType(), "INT64", "int"),
    "long": (LongType(), "INT64", "long"),
    "float": (DoubleType(), "FLOAT64", "double"),
    "double": (DoubleType(), "FLOAT64", "double"),
    "boolean": (BooleanType(), "BOOL", "boolean"),
    "bytes": (BinaryType(), "BYTES", "bytes"),
}

# Avro logical type -> (column type, its name in a schema string, base if unsaid).
# A time of day is stored as microseconds since midnight.
LOGICAL = {
    "timestamp-millis": (TimestampType(), "TIMESTAMP", "long"),
    "timestamp-micros": (TimestampType(), "TIMESTAMP", "long"),
    "iso-datetime": (TimestampType(), "TIMESTAMP", "string"),
    "date": (DateType(), "DATE", "int"),
    "time-millis": (LongType(), "TIME", "int"),
    "time-micros": (LongType(), "TIME", "long"),
}


@dataclass(frozen=True)
class AvroField:
    """One field of a record: enough to build its column and its checks."""

    name: str
    base: str
    logical: str | None = None
    nullable: bool = False

    @property
    def data_type(self) -> DataType:
        return LOGICAL[self.logical][0] if self.logical else PRIMITIVES[self.base][0]

    @property
    def type_name(self) -> str:
        return LOGICAL[self.logical][1] if self.logical else PRIMITIVES[self.base][1]

    @property
    def is_timestamp(self) -> bool:
        return isinstance(self.data_type, TimestampType)

    def nonconforming(self, value: str) -> str:
        """Publish-time check of a value that is present: the base type only."""
        return jsonx.mismatch(value, PRIMITIVES[self.base][2])

    def unreadable(self, value: str) -> str:
        """Is the value of a type the field's column cannot store?

        Timestamps go by the kind of value found, not by the declared base type.
        """
        kind = "moment" if self.is_timestamp else PRIMITIVES[self.base][2]
        return jsonx.mismatch(value, "long" if kind == "int" else kind)

    def read(self, value: str, moment: str, micros_as_millis: bool = False) -> str:
        """The column value of a readable cell; NULL for an absent or null one.

        ``moment`` names the cell's ``timex.iso_source``, needed for timestamps only.
        """
        if self.is_timestamp:
            in_micros = self.logical == "timestamp-micros" and not micros_as_millis
            number = timex.from_epoch(value, 1_000_000 if in_micros else 1_000)
            return f"""CASE WHEN {moment} IS NOT NULL THEN {timex.parse_iso(moment)}
              WHEN {jsonx.is_number(value)} THEN {number} END"""
        if self.logical == "date":
            if self.base == "string":
                return f"try_cast(try_cast({value} AS string) AS date)"
            return f"date_from_unix_date(try_cast({value} AS int))"
        if self.logical == "time-millis":
            return f"try_multiply(try_cast({value} AS bigint), 1000L)"
        if self.base == "bytes":
            text = f"try_cast({value} AS string)"
            one_byte_chars = f"CASE WHEN rlike({text}, r'{jsonx.ONE_BYTE_CHARS}') THEN {text} END"
            return f"encode({one_byte_chars}, 'ISO-8859-1')"
        return f"try_cast({value} AS {self.data_type.simpleString()})"


def _types_of(declared) -> list[tuple[str | None, str | None]]:
    """Every type a declaration allows, as (base, logical); a union allows several."""
    if isinstance(declared, list):
        return [found for branch in declared for found in _types_of(branch)]
    annotated = declared if isinstance(declared, dict) else {"type": declared}
    base, logical = annotated.get("type"), annotated.get("logicalType") or None
    if logical in LOGICAL and base not in PRIMITIVES:
        base = LOGICAL[logical][2]
    return [(base if isinstance(base, str) else None, logical)]


def _field(name: str, declared) -> AvroField:
    """A field from its declared type; the only place that says what is not supported."""
    types = _types_of(declared)
    stored = [found for found in types if found != ("null", None)]
    if isinstance(declared, list) and len(stored) != 1:
        # Fixed value: how this message begins.
        raise ValueError(f"Unsupported union type for field '{name}': only null and one other type can be stored")
    (base, logical), = stored or types
    if logical is not None and logical not in LOGICAL:
        raise ValueError(f"field '{name}' has a logical type without a column type: {logical}")
    if base not in PRIMITIVES:
        if isinstance(base, str) and base:
            # Fixed value: how this message begins.
            raise ValueError(f"Unsupported Avro primitive type: {base}")
        raise ValueError(f"field '{name}' has a type without a column type: {declared}")
    return AvroField(name, base, logical, len(stored) < len(types))


def fields_of(definition: str) -> list[AvroField]:
    """Fields of an Avro record in schema order."""
    return [_field(member["name"], member["type"]) for member in json.loads(definition)["fields"]]


def to_struct(definition: str) -> StructType:
    """Payload columns of a record. All are nullable: only publish checks enforce presence."""
    return StructType(
        [
            StructField(f.name, f.data_type, True, {"avro": f.logical or f.base, "warehouse": f.type_name})
            for f in fields_of(definition)
        ]
    )


def table_struct(definition: str) -> StructType:
    """Envelope columns, then payload columns."""
    payload = to_struct(definition)
    clash = sorted(set(ENVELOPE.fieldNames()) & set(payload.fieldNames()))
    if clash:
        raise ValueError(f"payload fields have the names of envelope columns: {clash}")
    return StructType(ENVELOPE.fields + payload.fields)


def schema_string(definition: str) -> str:
    """``name:TYPE,name:TYPE,...`` of envelope and payload."""
    names = {StringType(): "STRING", TimestampType(): "TIMESTAMP"}
    parts = [f"{f.name}:{names[f.dataType]}" for f in ENVELOPE.fields]
    parts += [f"{f.name}:{f.type_name}" for f in fields_of(definition)]
    return ",".join(parts)


def incompatibilities(old: str, new: str) -> list[str]:
    """Why two revisions cannot read each other's messages; empty if they can."""
    before = {f.name: f for f in fields_of(old)}
    after = {f.name: f for f in fields_of(new)}
    with_default = {
        text: {m["name"] for m in json.loads(text)["fields"] if "default" in m} for text in (old, new)
    }
    problems = []
    for name in sorted(before.keys() | after.keys()):
        if name not in before:
            if name not in with_default[new]:
                problems.append(f"added field has no default: {name}")
        elif name not in after:
            if name not in with_default[old]:
                problems.append(f"removed field has no default: {name}")
        elif (before[name].base, before[name].logical) != (after[name].base, after[name].logical):
            problems.append(f"field changes its type: {name}")
        elif before[name].nullable != after[name].nullable:
            problems.append(f"field changes whether it may be null: {name}")
    return problems
