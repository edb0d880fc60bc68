"""Enrichment of rides, filters, and chains of them; see ``operators.transforms``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions import jsonx
from tollgate.model import MESSAGE
from tollgate.operators import transforms
from tollgate.operators.routing import ERROR
from tollgate.operators.transforms import Document, Link

Transform = Callable[[DataFrame], DataFrame]

# Text that JavaScript converts to a number when it is compared with one.
_NUMERIC_TEXT = r"\A\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)\s*\z"


def region_of(latitude: Column) -> Column:
    """Region by latitude; anything that is not a number above the limits is downtown.

    Spark ranks NaN above every number, so NaN is ruled out first.
    """
    known = ~F.isnan(latitude)
    return (
        F.when(known & (latitude > 40.8), "north")
        .when(known & (latitude > 40.75), "midtown")
        .otherwise("downtown")
    )


def latitude_of(value: str) -> str:
    """SQL text of a variant as the number it compares as: numbers, and text that spells one."""
    text = f"try_cast({value} AS string)"
    return f"""CASE WHEN {jsonx.is_number(value)} THEN try_cast({value} AS double)
      WHEN {jsonx.kind(value)} = 'STRING' AND rlike({text}, r'{_NUMERIC_TEXT}')
      THEN try_cast(trim({text}) AS double) END"""


def iso_millis(clock: Column) -> Column:
    return F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def ride_enrichment(clock: Column | None = None) -> Link:
    """The link that sets ``enrichment_timestamp`` and ``region`` by the clock and the latitude."""

    def sets(document: Document) -> dict[str, Column]:
        now = F.current_timestamp() if clock is None else clock
        latitude = F.expr(latitude_of(document.sql("latitude")))
        return {"enrichment_timestamp": iso_millis(now), "region": region_of(latitude)}

    return Link("enrich_rides", sets=sets)


def enrich_rides(messages: DataFrame, clock: Column | None = None) -> DataFrame:
    """Set ``enrichment_timestamp`` and ``region`` in each payload, keeping all other members.

    A JSON payload that is not an object has no members to set and passes unchanged. One that is
    not JSON, or is ``null``, cannot be transformed and is not delivered; see
    ``untransformable``.
    """
    return transforms.delivered(transforms.apply(messages, [ride_enrichment(clock)]))


def untransformable(messages: DataFrame) -> DataFrame:
    """The messages no transform can read."""
    return transforms.apply(messages, []).where(F.col(ERROR).isNotNull()).select(*MESSAGE.fieldNames())


def chain(links: Sequence[Link]) -> Transform:
    """One transform that applies up to five in order and delivers what goes through all of them."""
    if len(links) > transforms.MAX_TRANSFORMS:
        raise ValueError(f"at most {transforms.MAX_TRANSFORMS} transforms, got {len(links)}")
    return lambda messages: transforms.delivered(transforms.apply(messages, links))


def keep_if(predicate: Callable[[Document], Column], name: str = "keep_if") -> Link:
    """The link that keeps messages for which ``predicate`` of the document is true."""
    return Link(name, keeps=predicate)
