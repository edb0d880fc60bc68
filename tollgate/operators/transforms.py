"""Chains of single-message transforms, with an outcome for every message.

A chain parses a payload once, whatever its number of links. What a link sets is kept beside the parsed document,
where the next links read it, and the payload is written once, after the last link. A message leaves a chain in
one of three ways: it is delivered, a link filters it out, or it is refused and becomes a dead letter.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions import envelope, jsonx
from tollgate.model import MESSAGE
from tollgate.operators import routing

# Fixed value: how many transforms one topic or subscription may have.
MAX_TRANSFORMS = 5

# The link that filtered a message out; NULL for the others.
DROPPED_BY = "_dropped_by"

_IS_NULL = r"rlike(_text, r'\A[ \t\r\n]*null[ \t\r\n]*\z')"


class Document:
    """A parsed payload inside a chain: ``document[name]`` is a member, a variant, as the earlier links left it.

    It is NULL for an absent member and for a payload that is not an object.
    """

    def __init__(self, values: dict[str, str]):
        self._values = dict(values)

    def __getitem__(self, name: str) -> Column:
        return F.expr(self.sql(name))

    def sql(self, name: str) -> str:
        """SQL text of a member."""
        key = name.replace("\\", "\\\\").replace("'", "\\'")
        return self._values.get(name, f"_cells['{key}']")


@dataclass(frozen=True)
class Link:
    """One transform. Each part is given the document and may be left out.

    ``refuses``: the label of an error, ``CLASS`` or ``CLASS:field``, or NULL to go on.
    ``keeps``: whether to go on; what is not true, NULL included, filters the message out.
    ``sets``: new values of members. NULL is written as ``null``; a payload that is not an object has no members to set.
    """

    name: str
    refuses: Callable[[Document], Column] | None = None
    keeps: Callable[[Document], Column] | None = None
    sets: Callable[[Document], dict[str, Column]] | None = None


def apply(messages: DataFrame, links: Sequence[Link]) -> DataFrame:
    """Messages after the chain, one row each, with ``_error``, ``_payload`` and ``_dropped_by``.

    A payload that is not JSON is refused, and so is ``null``, which has no members to read or set; other
    payloads that are no objects go through. The first link that refuses or filters decides, and no later link
    sees the message. ``data`` and ``_payload`` of a refused or filtered message are what they were. What was refused
    before, by another chain or a relay, stays so for that reason and is shown to no link.
    """
    if len(links) > MAX_TRANSFORMS:
        raise ValueError(f"at most {MAX_TRANSFORMS} transforms, got {len(links)}")
    df = messages.select(*MESSAGE.fieldNames(), *envelope.carried(messages), jsonx.decode_utf8(F.col("data")).alias("_text"))
    df = jsonx.with_members(df)
    unreadable = routing.first_failure(*routing.UNREADABLE[:2], (_IS_NULL, "NOT_AN_OBJECT"))
    error = F.expr(unreadable)
    if envelope.REFUSED in messages.columns:
        error = F.coalesce(f"{envelope.REFUSED}.error", error)
    df = jsonx.once(df, _end=F.struct(error.alias("error"), F.lit(None).cast("string").alias("dropped_by")))
    ends, values = ["_end"], {}
    for number, link in enumerate(links):
        # A message that has left the chain is shown to no link: what would fail on it is not evaluated.
        going = F.coalesce(*[F.coalesce(f"{end}.error", f"{end}.dropped_by") for end in ends]).isNull()
        document, end = Document(values), f"_end{number}"
        if link.refuses or link.keeps:
            error = F.when(going, link.refuses(document)) if link.refuses else F.lit(None).cast("string")
            df = jsonx.once(df, **{f"_refused{number}": error})
            here = going & F.col(f"_refused{number}").isNull()
            kept = F.coalesce(link.keeps(document), F.lit(False)) if link.keeps else F.lit(True)
            dropped = F.when(here, F.when(~kept, F.lit(link.name)))
            df = jsonx.once(df, **{end: F.struct(F.col(f"_refused{number}").alias("error"), dropped.alias("dropped_by"))})
            ends.append(end)
            going = going & F.coalesce(f"{end}.error", f"{end}.dropped_by").isNull()
        if link.sets:
            is_object = going & F.col("_cells").isNotNull()
            own = {name: F.when(is_object, value.cast("variant")) for name, value in link.sets(document).items()}
            columns = {name: f"_set{number}_{place}" for place, name in enumerate(own)}
            df = jsonx.once(df, **{columns[name]: value for name, value in own.items()})
            values |= columns
    first = {part: F.coalesce(*[f"{end}.{part}" for end in ends]) for part in ("error", "dropped_by")}
    df = df.withColumns({"_first_error": first["error"], DROPPED_BY: first["dropped_by"]})
    ended = F.coalesce("_first_error", DROPPED_BY).isNotNull()
    data = F.when(ended, F.col("data")).otherwise(F.coalesce(_written(values).cast("binary"), "data")) if values else F.col("data")
    return df.select(
        *[data.alias(name) if name == "data" else F.col(name) for name in MESSAGE.fieldNames()],
        *envelope.carried(messages),
        *routing.outcome("_first_error"),
        DROPPED_BY,
    )


def _written(values: dict[str, str]) -> Column:
    """The text of a document after the chain; NULL if it is not an object.

    A payload that has none of the members keeps its text byte for byte up to the closing brace. One that has
    any is written anew, because the old value must go: its members stay equal, but not their spelling or order.
    """
    texts = {name: F.coalesce(F.to_json(F.col(column)), F.lit("null")) for name, column in values.items()}
    members = F.concat(*[F.concat(F.lit(f",{json.dumps(name, ensure_ascii=False)}:"), text) for name, text in texts.items()])
    # The text is one object: before its last brace the members are added, and nothing else changes.
    space, text = F.lit(" \t\r\n"), F.rtrim("_text", F.lit(" \t\r\n"))
    body = F.rtrim(F.left(text, F.length(text) - 1), space)
    members = F.when(F.size("_cells") == 0, F.substr(members, F.lit(2))).otherwise(members)
    spliced = F.concat(body, members, F.lit("}"))
    null = F.parse_json(F.lit("null"))
    added = F.create_map(*[x for name, column in values.items() for x in (F.lit(name), F.coalesce(F.col(column), null))])
    others = F.map_filter("_cells", lambda key, _: ~key.isin(*values))
    replaced = F.to_json(F.map_concat(others, added))
    has_any = F.arrays_overlap(F.map_keys("_cells"), F.array(*map(F.lit, values)))
    return F.when(has_any, replaced).when(~has_any, spliced)


def delivered(applied: DataFrame) -> DataFrame:
    """The messages that went through."""
    gone = F.coalesce(routing.ERROR, DROPPED_BY)
    return applied.where(gone.isNull()).select(*MESSAGE.fieldNames(), *envelope.carried(applied))


def relayed(messages: DataFrame, links: Sequence[Link]) -> DataFrame:
    """A relay's messages after a subscription's chain, with ``reject_reason``: MESSAGE columns and the reason.

    Accepted messages go through the chain, and those that it delivers are kept; rejected ones pass by it. Both are of
    one pass: a relay's two sides taken apart would be checked twice.
    """
    refused = F.struct(F.col("reject_reason").alias("error"), F.lit(None).cast("string").alias("payload"))
    applied = apply(messages.withColumn(envelope.REFUSED, refused), links)
    reason = F.col(f"{envelope.REFUSED}.error")
    kept = applied.where(reason.isNotNull() | F.coalesce(routing.ERROR, DROPPED_BY).isNull())
    return kept.select(*MESSAGE.fieldNames(), reason.alias("reject_reason"))


def dead_letters(applied: DataFrame, subscription: str, clock: Column | None = None) -> DataFrame:
    """The dead-letter columns of the messages that the chain refused."""
    clock = F.current_timestamp() if clock is None else clock
    return routing.dead_letters(applied.withColumns({"processing_time": clock, "subscription_name": F.lit(subscription)}))


def counts() -> list[Column]:
    """Aggregates over an applied chain, also used as observed metrics of a stream."""
    refused, filtered = F.col(routing.ERROR).isNotNull(), F.col(DROPPED_BY).isNotNull()
    return [
        F.count_if(~refused & ~filtered).alias("delivered"),
        F.count_if(filtered).alias("filtered"),
        F.count_if(refused).alias("refused"),
    ]


def before(messages: DataFrame, links: Sequence[Link]) -> DataFrame:
    """Messages for a parser or a relay that come after a chain.

    Those filtered out are gone. Refused ones are kept and carry their error, which the parser's
    result takes over (``after``) and a relay gives as its reason. Counts are observed as ``transforms``.
    """
    applied = apply(messages, links).observe("transforms", *counts())
    refused = F.struct(F.col(routing.ERROR).alias("error"), F.col(routing.PAYLOAD).alias("payload"))
    going = applied.where(F.col(DROPPED_BY).isNull()).withColumn(envelope.REFUSED, refused)
    return going.select(*MESSAGE.fieldNames(), *envelope.carried(going))


def after(parsed: DataFrame) -> DataFrame:
    """A parsed DataFrame in which what a chain refused before is a dead letter, for the chain's reason."""
    was = F.col(f"{envelope.REFUSED}.error").isNotNull()
    kept = {
        routing.ERROR: F.coalesce(f"{envelope.REFUSED}.error", routing.ERROR),
        routing.PAYLOAD: F.when(was, F.col(f"{envelope.REFUSED}.payload")).otherwise(F.col(routing.PAYLOAD)),
    }
    return parsed.withColumns(kept).drop(envelope.REFUSED)
