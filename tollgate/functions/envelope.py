"""Message metadata columns shared by all ingestion paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Attribute names the schema registry stamps on a validated message.
SCHEMA_NAME_KEY = "googclient_schemaname"
SCHEMA_REVISION_KEY = "googclient_schemarevisionid"
SCHEMA_ENCODING_KEY = "googclient_schemaencoding"

# A column that messages may have beyond their own: the batch of a table that they are read from again.
ORIGIN = "_origin"

# Another: the error and payload of a message that a chain of transforms refused, both NULL for the others.
REFUSED = "_refused"


def carried(df: DataFrame) -> list[str]:
    """The origin and the refusal, if the rows have them; the paths hand them on."""
    return [name for name in (ORIGIN, REFUSED) if name in df.columns]


def attributes_json(attributes: Column) -> Column:
    """The attribute map as JSON text; ``{}`` for a missing or empty map."""
    return F.coalesce(F.to_json(attributes, {"ignoreNullFields": "false"}), F.lit("{}"))


def attribute(attributes: Column, key: str) -> Column:
    return F.coalesce(F.try_element_at(attributes, F.lit(key)), F.lit(""))


def metadata(subscription: str, clock: Column) -> list[Column]:
    """subscription_name, message_id, publish_time, processing_time."""
    return [
        F.lit(subscription).alias("subscription_name"),
        F.coalesce("message_id", F.lit("")).alias("message_id"),
        F.coalesce(F.col("publish_time"), clock).alias("publish_time"),
        clock.alias("processing_time"),
    ]


def governance() -> list[Column]:
    """schema_name, schema_revision_id, schema_encoding, empty text where not stamped."""
    attributes = F.col("attributes")
    return [
        attribute(attributes, SCHEMA_NAME_KEY).alias("schema_name"),
        attribute(attributes, SCHEMA_REVISION_KEY).alias("schema_revision_id"),
        attribute(attributes, SCHEMA_ENCODING_KEY).alias("schema_encoding"),
    ]


def stamped(attributes: Column, schema_name: str, revision_id: Column, encoding: str = "JSON") -> Column:
    """The attribute map with the three governance attributes set, replacing older ones."""
    keys = [SCHEMA_NAME_KEY, SCHEMA_REVISION_KEY, SCHEMA_ENCODING_KEY]
    others = F.map_filter(
        F.coalesce(attributes, F.create_map().cast("map<string,string>")),
        lambda key, _: ~key.isin(keys),
    )
    stamps = F.create_map(
        F.lit(keys[0]), F.lit(schema_name), F.lit(keys[1]), revision_id, F.lit(keys[2]), F.lit(encoding)
    )
    return F.map_concat(others, stamps)
