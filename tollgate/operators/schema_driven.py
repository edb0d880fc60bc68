"""Schema-driven path: columns and extraction generated from an Avro definition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions import envelope, jsonx, timex
from tollgate.model import MESSAGE
from tollgate.operators import routing
from tollgate.plans import avro


def parse_schema_driven(
    messages: DataFrame,
    subscription: str,
    definition: str,
    clock: Column | None = None,
    on_error: str = "fail",
    micros_as_millis: bool = False,
) -> DataFrame:
    """DataFrame[MESSAGE] to envelope plus the definition's fields.

    Absent keys give NULL and unknown keys are ignored. Messages are expected to have been
    validated when they were published, so by default one that cannot be read fails the job;
    ``on_error="quarantine"`` adds ``_error`` and ``_payload`` instead.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"on_error must be 'fail' or 'quarantine', not {on_error!r}")
    avro.table_struct(definition)  # rejects field names the envelope already uses
    fields = avro.fields_of(definition)
    clock = F.current_timestamp() if clock is None else clock

    df = messages.select(*MESSAGE.fieldNames(), *envelope.carried(messages), jsonx.decode_utf8(F.col("data")).alias("_text"))
    df = jsonx.with_cells(df, [f.name for f in fields])
    errors = [routing.first_failure(*routing.UNREADABLE)]
    columns = {}
    for number, run in enumerate(jsonx.chunks(fields)):
        df, failed = _read_run(df, run, f"_run{number}", micros_as_millis)
        errors.append(failed)
        columns.update({f.name: F.col(f"_run{number}")[f.name] for f in run})
    parsed = df.select(
        *envelope.metadata(subscription, clock),
        envelope.attributes_json(F.col("attributes")).alias("attributes"),
        *envelope.governance(),
        *[columns[f.name].alias(f.name) for f in fields],
        *routing.outcome(f"coalesce({', '.join(errors)})"),
        *envelope.carried(messages),
    )
    return routing.fail_on_error(parsed) if on_error == "fail" else parsed


def _read_run(
    df: DataFrame, fields: list[avro.AvroField], name: str, micros_as_millis: bool
) -> tuple[DataFrame, str]:
    """Add a struct of the fields' values, and name the column of the first failure among them."""

    def struct(members: dict[str, str]) -> str:
        return "named_struct(" + ", ".join(f"'{key}', {text}" for key, text in members.items()) + ")"

    def moment(f: avro.AvroField) -> str:
        return f"{name}_moments.{jsonx.quoted(f.name)}"

    moments = {f.name: timex.iso_source(jsonx.cell(f.name)) for f in fields if f.is_timestamp}
    if moments:
        df = jsonx.once(df, **{f"{name}_moments": struct(moments)})
    values = {f.name: f.read(jsonx.cell(f.name), moment(f), micros_as_millis) for f in fields}
    df = jsonx.once(df, **{name: struct(values)})
    checks = []
    for f in fields:
        value = jsonx.cell(f.name)
        checks.append((f.unreadable(value), f"TYPE_MISMATCH:{f.name}"))
        if f.logical:
            lost = f"NOT {jsonx.is_null(value)} AND {name}.{jsonx.quoted(f.name)} IS NULL"
            checks.append((lost, f"{'BAD_TIMESTAMP' if f.is_timestamp else 'TYPE_MISMATCH'}:{f.name}"))
    return jsonx.once(df, **{f"{name}_error": routing.first_failure(*checks)}), f"{name}_error"
