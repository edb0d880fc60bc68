"""Numbering rows into batches of a fixed count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Shards, and rows per batch.
SHARDS = 5
BATCH_SIZE = 100


def shard_of(message_id: Column, shards: int = SHARDS) -> Column:
    return F.pmod(F.xxhash64(message_id), F.lit(shards)).cast("int")


def number_batches(
    df: DataFrame, shard: Column, order: Sequence[str], stretch: Column, size: int = BATCH_SIZE
) -> DataFrame:
    """Add ``shard`` and ``batch_no``: rows of a shard, in order, in batches of ``size``.

    ``row_number`` over a shard would sort the whole shard in one task, and there are only a few shards.
    ``stretch`` cuts a shard into pieces that follow its order, such as the hour of the publish time: it
    must never decrease along ``order``. Rows are numbered within (shard, stretch), after the rows of
    the shard's earlier stretches. ``order`` must identify a row within its shard.
    """
    placed = df.withColumns({"shard": shard, "_stretch": stretch})
    held = placed.groupBy("shard", "_stretch").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy("shard").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select(F.col("shard").alias("_s"), F.col("_stretch").alias("_t"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("shard", "_stretch").orderBy(*order)) - 1
    same = F.col("shard").eqNullSafe(F.col("_s")) & F.col("_stretch").eqNullSafe(F.col("_t"))
    numbered = placed.withColumn("_within", within).join(before, same)
    batch = F.floor((F.col("_within") + F.col("_before")) / size).cast("bigint")
    return numbered.withColumn("batch_no", batch).drop("_stretch", "_within", "_s", "_t", "_before")
