"""The streaming jobs: three ingestion paths, the relay, and schema evolution.

Every job parses in the streaming plan itself, where the clock of a retried micro-batch is the
clock of its first attempt, and is stateless, so a query restarts on its checkpoint with a
changed projection.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from concurrent.futures import Future
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tollgate.functions import envelope
from tollgate.model import DEAD_LETTER, RAW, STANDARD
from tollgate.operators import routing, transforms, validate
from tollgate.operators.raw import as_messages, parse_raw
from tollgate.operators.schema_driven import parse_schema_driven
from tollgate.operators.standard import parse_standard
from tollgate.operators.transforms import Link
from tollgate.plans import avro, revisions, tables
from tollgate.sources.messages import bounded_stream

# Fixed value: how often buffered rows are flushed.
FLUSH = {"processingTime": "1 second"}

# Works off everything that has landed, in bounded micro-batches, and stops.
CATCH_UP = {"availableNow": True}


@dataclass(frozen=True)
class Target:
    """Where a job writes: table, checkpoint, and when."""

    table: str
    checkpoint: str
    trigger: dict | None = None

    @property
    def dead_letter_table(self) -> str:
        return f"{self.table}_dlq"

    def start(self, df: DataFrame, write: Callable[[DataFrame, str, int], None]) -> StreamingQuery:
        """Start a query that hands each micro-batch to ``write`` with the writer and the batch.

        The writer is the query's id. A checkpoint keeps it, so a restarted query goes on as the same
        writer, and one on a new checkpoint is another.
        """
        named: Future[str] = Future()
        stream = df.writeStream.option("checkpointLocation", self.checkpoint).queryName(_query_name(self.table, self.checkpoint))
        stream = stream.trigger(**(self.trigger or FLUSH))
        query = stream.foreachBatch(lambda rows, batch_id: write(rows, named.result(), batch_id)).start()
        named.set_result(query.id)
        return query


def _query_name(target: str, checkpoint: str) -> str:
    """Unique per checkpoint: a session may run several queries into one table or topic."""
    return re.sub(r"\W+", "_", f"{target} {checkpoint}")


def create_tables(spark: SparkSession, table: str, schema, location: str | None = None) -> None:
    """The table of a path and its dead-letter table."""
    tables.create_table(spark, table, schema, "publish_time", location)
    dead = f"{location}_dlq" if location else None
    tables.create_table(spark, f"{table}_dlq", DEAD_LETTER, "processing_time", dead)


def fan_out(target: Target) -> Callable[[DataFrame, str, int], None]:
    """Write a parsed micro-batch to the table and its dead-letter table, parsing it once."""

    def write(parsed: DataFrame, writer: str, batch_id: int) -> None:
        # Both writes read the same rows. The size of a micro-batch is bounded by the source.
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tables.append_batch(routing.table_rows(parsed), target.table, writer, batch_id, "publish_time")
            tables.append_batch(
                routing.dead_letters(parsed), target.dead_letter_table, writer, batch_id, "processing_time", clustered=False
            )
        finally:
            parsed.unpersist()

    return write


def _observed(parsed: DataFrame) -> DataFrame:
    """Metrics of each micro-batch in the query's progress, under ``ingest``: both outcomes, and the lag."""
    lag = F.expr("timestampdiff(MICROSECOND, publish_time, processing_time)") / 1_000_000
    failed = F.col(routing.ERROR).isNotNull() if routing.ERROR in parsed.columns else F.lit(False)
    return parsed.observe(
        "ingest",
        F.count_if(~failed).alias("rows"),
        F.count_if(failed).alias("dead_letters"),
        F.percentile_approx(lag, 0.95).alias("p95_lag_seconds"),
    )


def _start_with_dead_letters(parsed: DataFrame, schema, target: Target) -> StreamingQuery:
    spark = parsed.sparkSession
    tables.require_table(spark, target.table, schema)
    tables.require_table(spark, target.dead_letter_table, DEAD_LETTER)
    return target.start(_observed(parsed), fan_out(target))


def _through(links: Sequence[Link], messages: DataFrame, parse: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Parsed messages of a subscription whose transforms run before delivery, refused ones among the dead letters."""
    return transforms.after(parse(transforms.before(messages, links))) if links else parse(messages)


def start_standard(messages: DataFrame, subscription: str, target: Target, links: Sequence[Link] = ()) -> StreamingQuery:
    parsed = _through(links, messages, lambda df: parse_standard(df, subscription))
    return _start_with_dead_letters(parsed, STANDARD, target)


def start_raw(messages: DataFrame, subscription: str, target: Target, links: Sequence[Link] = ()) -> StreamingQuery:
    parsed = _through(links, messages, lambda df: parse_raw(df, subscription))
    return _start_with_dead_letters(parsed, RAW, target)


def start_schema_driven(
    messages: DataFrame,
    subscription: str,
    definition: str,
    target: Target,
    on_error: str = "fail",
    micros_as_millis: bool = False,
    links: Sequence[Link] = (),
) -> StreamingQuery:
    """One table. The definition is fixed for the life of the query.

    With ``on_error="quarantine"`` unreadable messages, and those the links refuse, go to a dead-letter table.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"on_error must be 'fail' or 'quarantine', not {on_error!r}")
    parsed = _through(
        links,
        messages,
        lambda df: parse_schema_driven(df, subscription, definition, on_error="quarantine", micros_as_millis=micros_as_millis),
    )
    if on_error == "fail":
        parsed = routing.fail_on_error(parsed)
    schema = avro.table_struct(definition)
    if on_error == "quarantine":
        return _start_with_dead_letters(parsed, schema, target)
    tables.require_table(messages.sparkSession, target.table, schema)

    def write(rows: DataFrame, writer: str, batch_id: int) -> None:
        tables.append_batch(rows, target.table, writer, batch_id, "publish_time")

    return target.start(_observed(parsed), write)


def start_relay(
    messages: DataFrame,
    allowed: list[revisions.Revision],
    schema_name: str,
    topic: str,
    checkpoint: str,
    trigger: dict | None = None,
    links: Sequence[Link] = (),
    ranges: Sequence[revisions.Range] = (),
) -> StreamingQuery:
    """Validate messages, after the topic's transforms if there are any, and publish them to a topic folder, accepted and rejected apart.

    The file sink's log makes each batch visible once, to the accepted and the rejected side
    together, and a stream that reads the folder follows that log. Counts of both sides are the
    observed metrics named ``relay`` of the query's progress.
    """
    if links:
        messages = transforms.before(messages, links)
    relayed = validate.relay(messages, allowed, schema_name, ranges)
    relayed = relayed.observe("relay", *validate.relay_counts())
    writer = relayed.withColumn("outcome", validate.outcome()).writeStream.format("parquet").partitionBy("outcome")
    writer = writer.option("checkpointLocation", checkpoint).option("path", topic).queryName(_query_name("relay", checkpoint))
    return writer.trigger(**(trigger or FLUSH)).start()


def stream_topic(spark: SparkSession, topic: str, max_files: int | None = None) -> DataFrame:
    """Accepted messages of a relay's topic folder; rejected files are never opened."""
    reader = bounded_stream(spark, validate.TOPIC, max_files, None)
    return validate.accepted(reader.parquet(topic).where("outcome = 'accepted'"))


def evolve(
    spark: SparkSession,
    registry: str,
    schema_name: str,
    definition: str,
    target: Target,
    running: StreamingQuery | None,
    messages: Callable[[], DataFrame],
    subscription: str,
    on_error: str = "fail",
    micros_as_millis: bool = False,
    topics: str | None = None,
    topic: str = "",
    links: Sequence[Link] = (),
) -> tuple[StreamingQuery, list[revisions.Revision]]:
    """Bring a schema-driven job to a new revision and restart it on its checkpoint.

    Steps, in order: commit the revision, widen the allowed range to it, stop the running query,
    add the table's new columns, start the query with the new definition. Only then may a
    producer send the new fields; sent earlier they would be accepted but not extracted. Each step
    changes nothing if it was done before, so a call that failed can be repeated. Returns the query and
    the widened range for the relay.

    With a table of ``topics`` the range is stored there: its first revision stays what it was, the new one
    becomes the last. Without one, all revisions are allowed.
    """
    newest = revisions.commit(spark, registry, schema_name, definition)
    first = None
    if topics is not None:
        stored = revisions.ranges(spark, topics, topic)
        first = stored[-1].first if stored else 1
        revisions.set_range(spark, topics, topic, schema_name, first, newest.ordinal)
    allowed = revisions.load(spark, registry, schema_name, first)
    if running is not None:
        running.stop()
    tables.evolve_table(spark, target.table, avro.table_struct(definition), "publish_time")
    query = start_schema_driven(messages(), subscription, definition, target, on_error, micros_as_millis, links)
    return query, allowed


# Bytes of raw rows that one task of a replay writes, about.
REPLAY_BYTES = 256 << 20


def replay(
    spark: SparkSession,
    raw_table: str,
    target: Target,
    parse: Callable[[DataFrame, str], DataFrame] = parse_standard,
    max_bytes: int = REPLAY_BYTES,
) -> int:
    """Parse the raw table's history again, into ``target``; returns the number of groups of batches.

    Batches are dealt to groups of about ``max_bytes``, which are the tasks of one job: the raw table is read a fixed
    number of times, whatever its size, and nothing is held beside what a task sorts. A batch becomes the same batch of
    a writer of its own: repeating a replay, or one that was cut off, replaces what was written, whatever the groups. A
    target whose replayed batches have been compacted cannot take them again; a new table can.
    """
    raw = spark.table(raw_table)
    targets = {target.table: "publish_time", target.dead_letter_table: "processing_time"}
    # What an earlier replay has written, from the catalog.
    held = {table: [b for b in tables.batches(spark, table) if b[0].startswith("replay-")] for table in targets}
    moved = reduce(DataFrame.unionByName, [spark.table(table + tables.MOVED) for table in targets])
    if not moved.where(F.col(tables.WRITER).startswith("replay-")).isEmpty():
        raise tables.TableError(f"replayed batches of {target.table} have been compacted: replay into a new table")
    size = F.octet_length("payload") + F.octet_length("attributes") + 64
    # A row for each writer. A batch comes from one job, and so from one subscription.
    writers = raw.groupBy("subscription_name", tables.WRITER).agg(
        F.sum(size).alias("bytes"), F.min(tables.BATCH).alias("low"), F.max(tables.BATCH).alias("high")
    ).collect()
    named = F.concat(F.lit("replay-"), F.col(tables.WRITER))
    groups = 0
    for subscription in sorted({row["subscription_name"] for row in writers}, key=lambda name: (name is not None, name)):
        own = [row for row in writers if row["subscription_name"] == subscription]
        ranges = {f"replay-{row[tables.WRITER]}": (row["low"], row["high"]) for row in own}
        count = -(-sum(row["bytes"] for row in own) // max_bytes)
        groups += count
        rows = raw.where(F.col("subscription_name").eqNullSafe(F.lit(subscription)))
        rows = rows.withColumn(envelope.ORIGIN, F.struct(named.alias(tables.WRITER), F.col(tables.BATCH)))
        parsed = parse(as_messages(rows), subscription)
        # Each outcome is a pass of its own: holding the parsed rows for both would take as much room as the table.
        for part, table in zip((routing.table_rows(parsed), routing.dead_letters(parsed)), targets):
            part = part.select("*", f"{envelope.ORIGIN}.*").drop(envelope.ORIGIN)
            # A task gets whole batches, and parts of those that are too large for one.
            tables.replace_batches(part.hint("rebalance", count, tables.WRITER, tables.BATCH), table, targets[table])
            again = [b for b in held[table] if b[0] in ranges and ranges[b[0]][0] <= b[1] <= ranges[b[0]][1]]
            if again:  # of these, batches that got no rows this time are removed
                written = {tuple(row) for row in part.select(tables.WRITER, tables.BATCH).distinct().collect()}
                tables.remove_batches(spark, table, [b for b in again if b not in written])
    return groups
