"""Raw path: check that the payload is JSON, keep its text unchanged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions import envelope, jsonx
from tollgate.model import MESSAGE
from tollgate.operators import routing


def parse_raw(messages: DataFrame, subscription: str, clock: Column | None = None) -> DataFrame:
    """DataFrame[MESSAGE] to the six raw columns plus ``_error`` and ``_payload``."""
    clock = F.current_timestamp() if clock is None else clock
    df = messages.select(*MESSAGE.fieldNames(), *envelope.carried(messages), jsonx.decode_utf8(F.col("data")).alias("_text"))
    df = jsonx.with_cells(df, [])
    error = routing.first_failure(*routing.UNREADABLE[:2])
    return df.select(
        *envelope.metadata(subscription, clock),
        envelope.attributes_json(F.col("attributes")).alias("attributes"),
        F.col("_text").alias("payload"),
        *routing.outcome(error),
        *envelope.carried(messages),
    )


def as_messages(raw: DataFrame) -> DataFrame:
    """Rows of the raw table as messages again, to replay history through another path."""
    return raw.select(
        F.col("payload").cast("binary").alias("data"),
        F.from_json("attributes", "map<string,string>").alias("attributes"),
        "message_id",
        "publish_time",
        *envelope.carried(raw),
    )
