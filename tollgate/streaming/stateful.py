"""Streams with state: repeated deliveries, and windows of event time.

State is bounded by a watermark, the greatest publish time seen less a delay. Messages without a publish time have
no event time: they are neither recognised as late nor counted in a window, and never move the watermark, which the
clock of a catch-up would push beyond the whole backlog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StructField, StructType, TimestampType

from tollgate.plans import reports, tables
from tollgate.streaming.jobs import Target

DELAY = "10 minutes"

MINUTES = StructType(
    [
        StructField("minute_time", TimestampType()),
        *[StructField(name, LongType()) for name in ("v2_count", "v1_count", "total")],
        *[StructField(f"{name}_lag_seconds", DoubleType()) for name in ("avg", "max", "p95")],
    ]
)


def first_deliveries(messages: DataFrame, delay: str = DELAY) -> DataFrame:
    """The first of the messages of one id that arrive within ``delay`` of each other's publish times.

    A repeat that comes when the watermark has passed the first one's time by more than the delay is a message again.
    Messages without an id cannot be told apart from others and all stay. One state entry of an id and a time is
    kept for each message of the last ``delay``; ids are shuffled once, by hash.
    """
    # An own key for each message that lacks an id or a time. A NULL time is never late, and its entry goes at once.
    known = F.col("message_id").isNotNull() & F.col("publish_time").isNotNull()
    key = F.when(known, F.concat(F.lit("id:"), F.col("message_id"))).otherwise(F.concat(F.lit("other:"), F.uuid()))
    kept = messages.withColumn("_key", key).withWatermark("publish_time", delay).dropDuplicatesWithinWatermark(["_key"])
    return kept.drop("_key")


def closed_minutes(table: DataFrame, delay: str = DELAY) -> DataFrame:
    """Each minute of publishing once, when no more of its rows are expected: counts and lag as the reports have them.

    Rows that come after the watermark has closed their minute are left out of it and counted in the progress of the
    query, as ``numRowsDroppedByWatermark``; the table that the job fills from still has them.
    """
    published = table.where("publish_time <> processing_time").withWatermark("publish_time", delay)
    lag = F.expr("timestampdiff(MICROSECOND, publish_time, processing_time)")
    minutes = published.groupBy(F.window("publish_time", "1 minute").alias("_window")).agg(
        *reports.minute_counts(),
        (F.avg(lag) / 1_000_000).alias("avg_lag_seconds"),
        (F.max(lag) / 1_000_000).alias("max_lag_seconds"),
        (F.percentile_approx(lag, 0.95) / 1_000_000).alias("p95_lag_seconds"),
    )
    return minutes.select(F.col("_window.start").alias("minute_time"), *MINUTES.fieldNames()[1:])


def start_minutes(table: DataFrame, target: Target, delay: str = DELAY) -> StreamingQuery:
    """Append closed minutes of a parsed stream to a table with the columns ``MINUTES``."""
    tables.require_table(table.sparkSession, target.table, MINUTES)

    def write(rows: DataFrame, writer: str, batch_id: int) -> None:
        tables.append_batch(rows, target.table, writer, batch_id, "minute_time")

    return target.start(closed_minutes(table, delay), write)
