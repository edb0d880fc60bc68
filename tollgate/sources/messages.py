"""Message sources: landing folders, a Kafka topic's columns, and the raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from tollgate.model import MESSAGE
from tollgate.session import configure


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """All messages in a landing folder."""
    return configure(spark).read.schema(MESSAGE).parquet(path)


# The file source skips files that are older than the newest by more than this; a backfill must not be.
_EVERY_AGE = "36500d"

# Bytes of a micro-batch unless a caller sets another bound.
MAX_BYTES = 1 << 30


def bounded_stream(spark: SparkSession, schema, max_files: int | None, max_bytes: int | None) -> DataStreamReader:
    """A file stream that reads files of any age, in micro-batches of bounded size."""
    reader = configure(spark).readStream.schema(schema).option("maxFileAge", _EVERY_AGE)
    if max_files is not None:
        return reader.option("maxFilesPerTrigger", max_files)
    return reader.option("maxBytesPerTrigger", max_bytes or MAX_BYTES)


def stream_landing(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Messages as they land. A bound on files or bytes, ``MAX_BYTES`` if none is given, limits a micro-batch.

    Each query reads on its own, with offsets in its own checkpoint: every subscription sees
    every message, and a restarted one goes on where it stopped.
    """
    return bounded_stream(spark, MESSAGE, max_files, max_bytes).parquet(path)


def from_kafka(records: DataFrame) -> DataFrame:
    """Rows of Spark's Kafka source (read with ``includeHeaders``) as messages.

    The last of several headers with one key wins.
    """
    headers = F.coalesce("headers", F.array().cast("array<struct<key:string,value:binary>>"))
    attributes = F.aggregate(
        headers,
        F.create_map().cast("map<string,string>"),
        lambda found, header: F.map_concat(
            F.map_filter(found, lambda key, _: key != header["key"]),
            F.create_map(header["key"], header["value"].cast("string")),
        ),
    )
    message_id = F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    return records.select(
        F.col("value").alias("data"),
        attributes.alias("attributes"),
        message_id.alias("message_id"),
        F.col("timestamp").alias("publish_time"),
    )


def merge_streams(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two producers of one topic."""
    return first.unionByName(second)
