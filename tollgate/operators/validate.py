"""Publish-time checks of messages against a range of schema revisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tollgate.functions import envelope, jsonx
from tollgate.model import MESSAGE
from tollgate.operators import routing
from tollgate.plans import avro
from tollgate.plans.revisions import Range, Revision


def _violation(f: avro.AvroField) -> str:
    """SQL text of the rule that a document in ``_cells`` breaks at a field, or NULL.

    A required field must be present and not null; a present value must have the field's base
    type, whatever its logical type says; unknown fields are accepted.
    """
    value = jsonx.cell(f.name)
    checks = [] if f.nullable else [(jsonx.is_null(value), f"MISSING_FIELD:{f.name}")]
    return routing.first_failure(*checks, (f.nonconforming(value), f"TYPE_MISMATCH:{f.name}"))


def _range_of(ranges: Sequence[Range]) -> Column:
    """The range that holds at a message's publish time; the last for a message without one.

    A message from before the first range has none, and matches no revision.
    """
    known = F.array(*[F.struct(F.lit(r.since).alias("since"), F.lit(r.first).alias("first"), F.lit(r.last).alias("last")) for r in ranges])
    begun = F.filter(known, lambda r: F.col("publish_time").isNull() | (r["since"] <= F.col("publish_time")))
    return F.try_element_at(begun, F.lit(-1))


def check(messages: DataFrame, revisions: Sequence[Revision], ranges: Sequence[Range] = ()) -> DataFrame:
    """Add ``revision_id`` and ``reject_reason`` to messages; exactly one of them is set.

    With ``ranges``, in the order in which they hold, a message is checked against the revisions that its topic allowed
    when it was published; where there are none, the reason is ``NO_REVISION``.

    Revisions are tried from the newest to the oldest and the first match is stamped. The
    reason of a rejected message is the one the newest revision gives. A field is checked once for
    all revisions that declare it alike, so a further revision costs what it changes.
    """
    newest_first = sorted(revisions, key=lambda r: r.ordinal, reverse=True)
    fields = {f.name: f for r in newest_first for f in avro.fields_of(r.definition)}
    df = messages.select(*MESSAGE.fieldNames(), *envelope.carried(messages), jsonx.decode_utf8(F.col("data")).alias("_text"))
    df = jsonx.with_cells(df, list(fields))
    unreadable = F.expr(routing.first_failure(*routing.UNREADABLE))
    if envelope.REFUSED in messages.columns:
        unreadable = F.coalesce(f"{envelope.REFUSED}.error", unreadable)
    of_revision = [avro.fields_of(r.definition) for r in newest_first]
    declared = [[(f.name, f.base, f.nullable) for f in own] for own in of_revision]
    shared = {key: f for keys, own in zip(declared, of_revision) for key, f in zip(keys, own)}
    columns = {key: f"_broken{number}" for number, key in enumerate(shared)}
    for run in jsonx.chunks(list(shared)):
        df = jsonx.once(df, **{columns[key]: _violation(shared[key]) for key in run})
    reasons = [F.coalesce(unreadable, *[F.col(columns[key]) for key in keys]) for keys in declared]
    allowed = [F.lit(True)] * len(reasons)
    if ranges:
        df = jsonx.once(df, _range=_range_of(ranges))
        allowed = [F.lit(r.ordinal).between(F.col("_range.first"), F.col("_range.last")) for r in newest_first]
    stamps = [F.when(may & why.isNull(), F.lit(r.revision_id)) for r, why, may in zip(newest_first, reasons, allowed)]
    revision_id = F.coalesce(*stamps)
    reason = reasons[0]
    if ranges:
        reason = F.coalesce(unreadable, *[F.when(may, why) for why, may in zip(reasons, allowed)], F.lit("NO_REVISION"))
    return df.select(
        *MESSAGE.fieldNames(),
        revision_id.alias("revision_id"),
        F.when(revision_id.isNull(), reason).alias("reject_reason"),
    )


def relay(messages: DataFrame, revisions: Sequence[Revision], schema_name: str, ranges: Sequence[Range] = ()) -> DataFrame:
    """Re-publish messages to a validated topic: MESSAGE columns and ``reject_reason``.

    Only the payload is re-published. An accepted message carries the three governance
    attributes and nothing else; a rejected one carries none.
    """
    checked = check(messages, revisions, ranges)
    stamps = envelope.stamped(F.lit(None), schema_name, F.col("revision_id"))
    return checked.select(
        "data",
        F.when(F.col("revision_id").isNotNull(), stamps).alias("attributes"),
        "message_id",
        "publish_time",
        "reject_reason",
    )


# What a relay publishes, by outcome.
TOPIC = StructType([*MESSAGE.fields, StructField("reject_reason", StringType()), StructField("outcome", StringType())])


def outcome() -> Column:
    return F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected")


def accepted(relayed: DataFrame) -> DataFrame:
    return relayed.where(F.col("reject_reason").isNull()).select(*MESSAGE.fieldNames())


def rejected(relayed: DataFrame) -> DataFrame:
    return relayed.where(F.col("reject_reason").isNotNull())


def relay_counts() -> list[Column]:
    """Aggregates over a relayed DataFrame, also used as observed metrics of the stream."""
    is_rejected = F.col("reject_reason").isNotNull()
    return [F.count_if(~is_rejected).alias("published"), F.count_if(is_rejected).alias("errors")]


def compatibility_audit(messages: DataFrame, candidate: Revision) -> DataFrame:
    """How many retained messages a candidate revision accepts, and why it rejects the others."""
    reason = F.coalesce("reject_reason", F.lit("CONFORMS"))
    return check(messages, [candidate]).groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))
