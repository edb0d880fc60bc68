"""Typed path: fixed columns, defaults for absent keys, dead letters for the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType

from tollgate.functions import envelope, jsonx, timex
from tollgate.model import MESSAGE, RIDE_FIELDS, STANDARD, STANDARD_DEFAULTS
from tollgate.operators import routing

_BASE = {StringType(): "string", LongType(): "long", DoubleType(): "double"}


def parse_standard(
    messages: DataFrame, subscription: str, clock: Column | None = None
) -> DataFrame:
    """DataFrame[MESSAGE] to the 14 typed columns plus ``_error`` and ``_payload``.

    Checks run in a fixed order and the first that fails names the dead letter: text, JSON,
    object, timestamp, then each field in column order.
    """
    clock = F.current_timestamp() if clock is None else clock
    df = messages.select(*MESSAGE.fieldNames(), *envelope.carried(messages), jsonx.decode_utf8(F.col("data")).alias("_text"))
    df = jsonx.with_cells(df, [f.name for f in RIDE_FIELDS])
    moment = jsonx.cell("timestamp")
    not_text = f"{jsonx.kind(moment)} NOT IN ('STRING', 'VOID')"
    error = routing.first_failure(
        *routing.UNREADABLE,
        (f"{not_text} AND NOT {jsonx.is_falsy(moment)}", "BAD_TIMESTAMP:timestamp"),
        *[
            (jsonx.mismatch(jsonx.cell(name), _BASE[STANDARD[name].dataType]), f"TYPE_MISMATCH:{name}")
            for name in STANDARD_DEFAULTS
        ],
    )
    # Apart from each other, so that no generated method grows too large; see jsonx.chunks.
    df = jsonx.once(df, _error=error)
    df = jsonx.once(df, _source=timex.iso_source(moment))
    df = jsonx.once(df, _moment=timex.parse_iso("_source"))

    values = {
        **{name: F.expr(_typed(name)) for name in STANDARD_DEFAULTS},
        "timestamp": F.col("_moment"),
        "attributes": envelope.attributes_json(F.col("attributes")),
    }
    return df.select(
        *envelope.metadata(subscription, clock),
        *[values[name].alias(name) for name in STANDARD.fieldNames() if name in values],
        *routing.outcome("_error"),
        *envelope.carried(messages),
    )


def _typed(name: str) -> str:
    value, default = jsonx.cell(name), STANDARD_DEFAULTS[name]
    data_type = STANDARD[name].dataType.simpleString()
    return f"CASE WHEN {value} IS NULL THEN CAST({default!r} AS {data_type}) ELSE try_cast({value} AS {data_type}) END"
