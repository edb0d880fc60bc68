"""Splitting parsed messages into table rows and dead letters.

A parsed DataFrame carries the table columns plus ``_error`` and ``_payload``. Both are NULL
for a row of the table; otherwise they hold why the message is a dead letter, as ``CLASS`` or
``CLASS:field``, and its payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions import envelope
from tollgate.model import DEAD_LETTER

ERROR = "_error"
PAYLOAD = "_payload"

# Error classes and what each says.
MESSAGES = {
    "INVALID_UTF8": "payload is not valid UTF-8",
    "INVALID_JSON": "payload is not exactly one JSON value",
    "NOT_AN_OBJECT": "payload is JSON but not an object",
    "BAD_TIMESTAMP": "timestamp value cannot be read",
    "TYPE_MISMATCH": "value does not have the type of the column",
}


def first_failure(*checks: tuple[str, str]) -> str:
    """SQL text of the label of the first check whose condition is true, else NULL."""
    whens = " ".join(f"WHEN {condition} THEN '{label}'" for condition, label in checks)
    return f"CASE {whens} END"


# What every path that reads members checks before any of them.
UNREADABLE = (
    ("_text IS NULL", "INVALID_UTF8"),
    ("NOT _is_json", "INVALID_JSON"),
    ("_cells IS NULL", "NOT_AN_OBJECT"),
)


def outcome(error: str) -> list[Column]:
    """``_error`` and ``_payload``; bytes that are not text are kept as hex."""
    payload = "coalesce(_text, '0x' || hex(data), '')"
    return [
        F.expr(error).alias(ERROR),
        F.expr(f"CASE WHEN {error} IS NOT NULL THEN {payload} END").alias(PAYLOAD),
    ]


def error_class(error: Column | str = ERROR) -> Column:
    return F.substring_index(error, ":", 1)


def table_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(ERROR).isNull()).drop(ERROR, PAYLOAD)


def dead_letters(parsed: DataFrame) -> DataFrame:
    """The five dead-letter columns of the messages that failed."""
    failed = parsed.where(F.col(ERROR).isNotNull())
    field = F.split_part(F.col(ERROR), F.lit(":"), F.lit(2))
    described = F.create_map(*[F.lit(part) for pair in MESSAGES.items() for part in pair])
    columns = {
        "error_message": F.concat(
            described[error_class()], F.when(field == "", "").otherwise(F.concat(F.lit(": "), field))
        ),
        "stack_trace": F.concat(
            error_class(), F.lit(" at "), F.when(field == "", "payload").otherwise(field)
        ),
        "original_payload": F.col(PAYLOAD),
    }
    return failed.select(
        *[columns.get(name, F.col(name)).alias(name) for name in DEAD_LETTER.fieldNames()],
        *envelope.carried(parsed),
    )


def fail_on_error(parsed: DataFrame) -> DataFrame:
    """Table rows only; the job fails at the first message that has none."""
    report = F.concat(F.col(ERROR), F.lit(" in payload: "), F.col(PAYLOAD))
    # raise_error sits in the filter: a projected column could be pruned, a filter cannot.
    checked = F.when(F.col(ERROR).isNull(), F.lit(True)).otherwise(
        F.raise_error(report).cast("boolean")
    )
    return parsed.where(checked).drop(ERROR, PAYLOAD)


def routed_to() -> Column:
    return F.when(F.col(ERROR).isNull(), F.lit("table")).otherwise(F.lit("dead_letter"))
