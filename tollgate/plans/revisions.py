"""Schema revisions, kept in a small table.

A schema has at most twenty revisions, so reading one schema's rows on the driver is bounded.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tollgate.plans import avro

# Limits of the registry.
MAX_REVISIONS = 20
ID_LENGTH = 8

RANGES = "topic string, schema_name string, first int, last int, since timestamp, version int"
SCHEMA = "schema_name string, revision_id string, ordinal int, definition string"


@dataclass(frozen=True)
class Revision:
    schema_name: str
    revision_id: str
    ordinal: int
    definition: str


def make_revision(schema_name: str, ordinal: int, definition: str) -> Revision:
    """A revision with an id that depends on the schema, its place and its text."""
    digest = sha256(f"{schema_name}\n{ordinal}\n{definition}".encode()).hexdigest()
    return Revision(schema_name, digest[:ID_LENGTH], ordinal, definition)


@dataclass(frozen=True)
class Range:
    """The revisions that a topic allows from ``since`` until the next range."""

    topic: str
    schema_name: str
    first: int
    last: int
    since: datetime
    version: int


def ranges(spark: SparkSession, path: str, topic: str) -> list[Range]:
    """All ranges a topic has had, in the order in which they hold; the last is the current one.

    A range is set by hand, or once a revision, so a topic has few.
    """
    try:
        table = spark.read.schema(RANGES).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    # Instants leave Spark as numbers: rows would hold them in the clock of this process.
    rows = table.where(F.col("topic") == topic).withColumn("since", F.unix_micros("since")).orderBy("since", "version").collect()
    return [Range(**{**row.asDict(), "since": datetime.fromtimestamp(row["since"] / 1e6, timezone.utc)}) for row in rows]


def set_range(
    spark: SparkSession, path: str, topic: str, schema_name: str, first: int, last: int, since: datetime | None = None
) -> Range:
    """Allow the revisions ``first`` to ``last`` on a topic, from ``since`` (now) on.

    The current range is returned as it is if it has these limits, so a call can be repeated.
    """
    if not 1 <= first <= last:
        raise ValueError(f"no range of revisions: {first} to {last}")
    stored = ranges(spark, path, topic)
    if stored and (stored[-1].schema_name, stored[-1].first, stored[-1].last) == (schema_name, first, last):
        return stored[-1]
    since = since or datetime.now(timezone.utc)
    if stored and since < stored[-1].since:
        raise ValueError(f"the range of {topic} since {stored[-1].since} cannot be changed for earlier messages")
    new = Range(topic, schema_name, first, last, since, len(stored) + 1)
    row = spark.createDataFrame([tuple(vars(new).values())], RANGES)
    row.coalesce(1).write.mode("append").parquet(path)
    if sum(r.version == new.version for r in ranges(spark, path, topic)) > 1:
        raise ValueError(f"another range of {topic} was set at the same time")
    return new


def load(
    spark: SparkSession,
    path: str,
    schema_name: str,
    first: int | None = None,
    last: int | None = None,
) -> list[Revision]:
    """Revisions of a schema in the allowed range of ordinals, newest first."""
    try:
        table = spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    rows = table.where(F.col("schema_name") == schema_name)
    if first is not None:
        rows = rows.where(F.col("ordinal") >= first)
    if last is not None:
        rows = rows.where(F.col("ordinal") <= last)
    # One more than allowed is enough to see that there are too many.
    found = rows.orderBy(F.desc("ordinal")).limit(MAX_REVISIONS + 1).collect()
    if len(found) > MAX_REVISIONS:
        raise ValueError(f"schema {schema_name} has more than {MAX_REVISIONS} revisions")
    return [Revision(**row.asDict()) for row in found]


def commit(spark: SparkSession, path: str, schema_name: str, definition: str) -> Revision:
    """Append a revision that every earlier one is compatible with.

    The newest revision is returned as it is if it has this definition, so a commit can be repeated.
    """
    existing = load(spark, path, schema_name)
    if existing and existing[0].definition == definition:
        return existing[0]
    if len(existing) >= MAX_REVISIONS:
        raise ValueError(f"schema {schema_name} already has {MAX_REVISIONS} revisions")
    avro.fields_of(definition)
    for revision in existing:
        problems = avro.incompatibilities(revision.definition, definition)
        if problems:
            raise ValueError(f"incompatible with revision {revision.revision_id}: {problems}")
    ordinal = existing[0].ordinal + 1 if existing else 1
    revision = make_revision(schema_name, ordinal, definition)
    row = (revision.schema_name, revision.revision_id, revision.ordinal, revision.definition)
    spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    if sum(r.ordinal == ordinal for r in load(spark, path, schema_name)) > 1:
        raise ValueError(f"another revision {ordinal} of {schema_name} was committed at the same time")
    return revision
