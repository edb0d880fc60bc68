"""Tables of the session catalog: creating, evolving, idempotent appends, and compaction by day.

A table is a view over three stored tables:

- ``<name>_recent`` takes the micro-batches, partitioned by writer and batch. A retried batch replaces its own
  partition, which makes appending it exactly-once, and a batch costs a file per task however many days its rows are
  of. A writer is one checkpoint: any number of them, and renewed ones, append without touching each other's rows.
- ``<name>_days`` holds closed days, partitioned by day and by the compaction run that wrote them, in large files
  sorted by time.
- ``<name>_moved`` says what has been compacted: the rows of each run name, for every writer, the last batch and the
  last day whose rows have moved. The view takes from ``_days`` the runs that are listed and from ``_recent`` what
  the latest run has not moved, so a run becomes visible, and its input invisible, by the one file that lists it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tollgate.functions.jsonx import quoted
from tollgate.session import configure

WRITER, BATCH = "writer", "batch_id"

# Columns of the layout, which follow a table's own: writer, batch, day.
_LAYOUT = 3

# What a table is stored in.
RECENT, DAYS, MOVED = "_recent", "_days", "_moved"

_MOVED_COLUMNS = "run BIGINT, writer STRING, up_to BIGINT, cutoff DATE"
# Partitions named in one statement.
_PARTITIONS = 500


class TableError(ValueError):
    """A table is missing or does not have the columns a job writes."""


def day_column(time_column: str) -> str:
    """``publish_time`` is laid out by ``publish_date``, ``processing_time`` likewise."""
    return time_column.removesuffix("_time") + "_date"


def ddl(schema: StructType) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def create_table(
    spark: SparkSession, name: str, schema: StructType, time_column: str, location: str | None = None
) -> None:
    """Create an empty table, laid out by the day of ``time_column`` once its days are closed."""
    day = day_column(time_column)

    def place(part: str) -> str:
        return f" LOCATION '{location}/{part.removeprefix('_')}'" if location else ""

    spark.sql(
        f"CREATE TABLE {name}{RECENT} ({ddl(schema)}, {day} DATE, {WRITER} STRING, {BATCH} BIGINT) USING parquet "
        f"PARTITIONED BY ({WRITER}, {BATCH}){place(RECENT)}"
    )
    spark.sql(
        f"CREATE TABLE {name}{DAYS} ({ddl(schema)}, {WRITER} STRING, {BATCH} BIGINT, {day} DATE, run BIGINT) USING parquet "
        f"PARTITIONED BY ({day}, run){place(DAYS)}"
    )
    spark.sql(f"CREATE TABLE {name}{MOVED} ({_MOVED_COLUMNS}) USING parquet{place(MOVED)}")
    _create_view(spark, name, schema.fieldNames(), day)


def _create_view(spark: SparkSession, name: str, columns: Sequence[str], day: str) -> None:
    listed = ", ".join(map(quoted, [*columns, WRITER, BATCH, day]))
    latest = f"(SELECT max(run) FROM {name}{MOVED})"
    spark.sql(
        f"""CREATE OR REPLACE VIEW {name} AS
        SELECT {listed} FROM {name}{DAYS} WHERE run <= {latest}
        UNION ALL
        SELECT {listed} FROM {name}{RECENT} LEFT ANTI JOIN (
          SELECT {WRITER} AS _writer, up_to, cutoff FROM {name}{MOVED} WHERE run = {latest}
        ) ON {WRITER} = _writer AND {BATCH} <= up_to AND coalesce({day} <= cutoff, true)"""
    )


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for part in (RECENT, DAYS, MOVED):
        spark.sql(f"DROP TABLE IF EXISTS {name}{part}")


def columns_of(spark: SparkSession, name: str) -> dict[str, str]:
    """Data columns of a table with their types, without those of the layout."""
    return dict(spark.table(name).dtypes[:-_LAYOUT])


def require_table(spark: SparkSession, name: str, schema: StructType) -> None:
    """A job only appends: it neither creates a table nor changes one."""
    if not spark.catalog.tableExists(name):
        raise TableError(f"table does not exist: {name}")
    existing = columns_of(spark, name)
    for f in schema.fields:
        if existing.get(f.name) != f.dataType.simpleString():
            raise TableError(f"table {name} has no column {f.name} {f.dataType.simpleString()}")


def evolve_table(
    spark: SparkSession, name: str, schema: StructType, time_column: str, location: str | None = None
) -> list[str]:
    """Create the table, or add the columns it lacks; returns the names of added columns.

    Columns are never dropped or retyped. Rows written before read NULL in an added column: the
    catalog holds the schema, so no file footers are merged to find it.
    """
    if not spark.catalog.tableExists(name):
        create_table(spark, name, schema, time_column, location)
        return schema.fieldNames()
    existing = columns_of(spark, name)
    retyped = [f.name for f in schema.fields if existing.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString()]
    if retyped:
        raise TableError(f"table {name} has other types for: {retyped}")
    added = StructType([f for f in schema.fields if f.name not in existing])
    if added.fields:
        # A call that was cut off may have added them to one part already.
        for part in (RECENT, DAYS):
            stored = set(spark.table(name + part).columns)
            missing = StructType([f for f in added.fields if f.name not in stored])
            if missing.fields:
                spark.sql(f"ALTER TABLE {name}{part} ADD COLUMNS ({ddl(missing)})")
        _create_view(spark, name, [*existing, *added.fieldNames()], day_column(time_column))
    return added.fieldNames()


def _laid_out(rows: DataFrame, name: str, time_column: str, sort: Sequence[str] = ()) -> DataFrame:
    """The columns of ``<name>_recent`` in its order; columns that the rows lack are NULL."""
    stored = rows.sparkSession.table(name + RECENT).dtypes
    rows = rows.withColumn(day_column(time_column), F.to_date(time_column))
    if sort:
        rows = rows.sortWithinPartitions(*sort)
    present = set(rows.columns)
    return rows.select(*[F.col(quoted(c)) if c in present else F.lit(None).cast(kind).alias(c) for c, kind in stored])


def append_batch(
    rows: DataFrame, name: str, writer: str, batch_id: int, time_column: str, clustered: bool = True
) -> None:
    """Write one batch, replacing what an earlier attempt of this writer at the same batch wrote.

    Rows are sorted by time within each file, so row groups can be skipped by their bounds.
    """
    if not writer.replace("-", "").isalnum():
        raise ValueError(f"a writer is named by letters, digits and dashes: {writer}")
    rows = _laid_out(rows, name, time_column, [time_column] if clustered else []).drop(WRITER, BATCH)
    columns = ", ".join(map(quoted, rows.columns))
    rows.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {name}{RECENT} PARTITION ({WRITER} = '{writer}', {BATCH} = {batch_id}) "
        f"({columns}) SELECT {columns} FROM {{rows}}",
        rows=rows,
    )


def replace_batches(rows: DataFrame, name: str, time_column: str) -> None:
    """Write many batches in one job. ``rows`` say in ``writer`` and ``batch_id`` which one they are of.

    Each batch that has rows replaces what the table held of it. Only batches that have not been compacted can be
    replaced.
    """
    configure(rows.sparkSession)  # dynamic overwriting
    laid = _laid_out(rows, name, time_column).sortWithinPartitions(WRITER, BATCH, time_column)
    laid.write.insertInto(name + RECENT, overwrite=True)


def remove_batches(spark: SparkSession, name: str, listed: Sequence[tuple[str, int]]) -> None:
    """Drop batches and their files, which a table with a location of its own would keep."""
    table = f"{name}{RECENT}"
    place = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
    for begin in range(0, len(listed), _PARTITIONS):
        some = listed[begin : begin + _PARTITIONS]
        parts = ", ".join(f"PARTITION ({WRITER} = '{writer}', {BATCH} = {batch})" for writer, batch in some)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
        for writer, batch in some:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/{WRITER}={writer}/{BATCH}={batch}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if listed:
        spark.catalog.refreshTable(table)


def _moved(spark: SparkSession, name: str) -> tuple[int, DataFrame]:
    """The latest compaction run, 0 if there was none, and what it says: writer, up_to, cutoff."""
    moved = spark.table(name + MOVED)
    run = moved.agg(F.coalesce(F.max("run"), F.lit(0))).first()[0]
    return run, moved.where(F.col("run") == run).select(WRITER, "up_to", "cutoff")


def _unmoved(rows: DataFrame, moved: DataFrame, day: str) -> DataFrame:
    held = moved.withColumnRenamed(WRITER, "_writer")
    inside = (F.col(WRITER) == F.col("_writer")) & (F.col(BATCH) <= F.col("up_to"))
    return rows.join(held, inside & F.coalesce(F.col(day) <= F.col("cutoff"), F.lit(True)), "left_anti")


def compact(spark: SparkSession, name: str, before: date, finished: Sequence[str] = ()) -> int:
    """Move the rows of days before ``before`` into large files by day; returns the run, or 0 if nothing was left.

    The last batch of a writer stays, as a restarted writer repeats it, unless the writer is ``finished`` for good.
    Days may come to a table late: a later run then adds a file to theirs. A run is written first, then listed, and
    last its input is removed. One that is cut off before it is listed is written anew under its number; one that is
    cut off later has its input removed by the next call. One call may run on a table at a time, beside any writers.
    """
    day = spark.table(name).columns[-1]
    time_column = day.removesuffix("_date") + "_time"
    last, moved = _moved(spark, name)
    _clean(spark, name, day, moved)
    held = spark.table(name + RECENT)
    top = held.groupBy(WRITER).agg(F.max(BATCH).alias("up_to"))
    idle = F.col(WRITER).isin(list(finished)) if finished else F.lit(False)
    top = top.withColumn("up_to", F.when(idle, F.col("up_to")).otherwise(F.col("up_to") - 1))
    earlier = moved.select(WRITER, F.col("up_to").alias("_up_to"), F.col("cutoff").alias("_cutoff"))
    # Both bounds of a writer only grow, so what it says includes what earlier runs have moved.
    bounds = top.join(earlier, WRITER, "full").select(
        WRITER,
        F.greatest("up_to", "_up_to").alias("up_to"),
        F.greatest(F.lit(before).cast("date") - F.expr("INTERVAL 1 DAY"), F.col("_cutoff")).cast("date").alias("cutoff"),
    )
    stored = spark.createDataFrame(bounds.collect(), bounds.schema)  # a row for each writer
    chosen = held.join(
        F.broadcast(stored.withColumnRenamed(WRITER, "_writer")),
        (F.col(WRITER) == F.col("_writer")) & (F.col(BATCH) <= F.col("up_to")) & F.coalesce(F.col(day) <= F.col("cutoff"), F.lit(True)),
        "left_semi",
    )
    chosen = _unmoved(chosen, moved, day)
    if chosen.isEmpty():
        return 0
    run = last + 1
    _discard_run(spark, name, run)
    columns = [c for c in spark.table(name + DAYS).columns if c != "run"]
    # A task gets whole days, and splits of days that are too large for one.
    rows = chosen.hint("rebalance", F.col(day)).sortWithinPartitions(day, time_column)
    rows = rows.select(*[quoted(c) for c in columns], F.lit(run).cast("long").alias("run"))
    rows.write.insertInto(name + DAYS)
    _list_run(spark, name, run, stored)
    _clean(spark, name, day, stored)
    return run


def _list_run(spark: SparkSession, name: str, run: int, bounds: DataFrame) -> None:
    """The step that makes a run visible: one file."""
    rows = bounds.select(F.lit(run).cast("long").alias("run"), WRITER, "up_to", "cutoff")
    rows.coalesce(1).write.insertInto(name + MOVED)


def _discard_run(spark: SparkSession, name: str, run: int) -> None:
    """Remove what a run that was never listed has written."""
    table = f"{name}{DAYS}"
    place = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
    listed = [row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").where(F.col("partition").endswith(f"/run={run}")).collect()]
    for partition in listed:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/{partition}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if listed:
        spark.catalog.refreshTable(table)


def _clean(spark: SparkSession, name: str, day: str, moved: DataFrame) -> None:
    """Remove batches all of whose rows have moved."""
    held = spark.table(name + RECENT).groupBy(WRITER, BATCH).agg(F.max(day).alias("_last"))
    bounds = moved.withColumnRenamed(WRITER, "_writer")
    inside = (F.col(WRITER) == F.col("_writer")) & (F.col(BATCH) <= F.col("up_to"))
    done = held.join(bounds, inside & F.coalesce(F.col("_last") <= F.col("cutoff"), F.lit(True)), "left_semi")
    remove_batches(spark, name, [(row[WRITER], row[BATCH]) for row in done.select(WRITER, BATCH).collect()])


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """The data columns and the day, without writer and batch."""
    return spark.table(name).drop(WRITER, BATCH)


def batches(spark: SparkSession, name: str) -> list[tuple[str, int]]:
    """Writers and batches that have not been compacted, from the catalog's list of partitions."""
    listed = spark.sql(f"SHOW PARTITIONS {name}{RECENT}").collect()
    keys = [dict(part.split("=", 1) for part in row[0].split("/")) for row in listed]
    return sorted({(key[WRITER], int(key[BATCH])) for key in keys})


def between(time_column: str, start: Column, end: Column) -> Column:
    """Rows of a half-open time range, with the day bounds that let partitions be pruned."""
    day = F.col(day_column(time_column))
    moment = F.col(time_column)
    return (moment >= start) & (moment < end) & (day >= F.to_date(start)) & (day <= F.to_date(end))
