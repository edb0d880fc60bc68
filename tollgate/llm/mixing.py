"""Mixing sources to target weights along a low-discrepancy schedule.

Every source is a stream: its documents in a shuffled order, then the same order again, cut into blocks of
equally many words. A schedule deals slots to sources: slot ``i`` is the golden-ratio point
``i * phi mod 1``, and falls to the source whose interval of cumulative shares holds the point. The slots of
a source are ranked, and its slot of rank ``r`` reads its block ``r``. So any run of slots, from the start
or not, holds all sources close to their shares.

The target of a source is its weight's part of all words wanted, at most ``epochs`` times its size; what a
source cannot give is shared again by weight among the others.

Scale: sizes are counted once and saved; positions in a stream are prefix sums over buckets of the shuffle
(no group holds a whole source), and slots are ranked in runs of ``_RUN`` in the same way. A block grows with
the square root of the words wanted, so a mix has moderately many slots of moderate length at any size.

NULL or empty texts have size 0 and are never taken; a NULL source is a source, ordered last. Rows that
repeat a ``doc_id`` are documents of their own. An empty table, or one without words, gives no blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import n_words, saved

#: 2**31 over the golden ratio, odd: multiples of it modulo 2**31 are the points of the schedule.
_GOLDEN = 1327217885
_CIRCLE = 1 << 31
#: The circle is cut into cells of this length, by which slots find the interval they fall into.
_CELL = 1 << 19
#: Slots that are ranked together.
_RUN = 1 << 16
#: Documents in a bucket of the shuffle, about.
_BUCKET = 4_000


def targets(sizes: DataFrame, wanted: float, weights: list[int], epochs: int) -> DataFrame:
    """Add ``target`` to sources (source, source_size): water-filling under the cap ``epochs * source_size``.

    ``weights`` repeat over the sources in order of code points, NULL last. A row per source, so one window
    over all of them is small.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (number % len(weights) + 1).cast("int"))
    level = Window.orderBy("_full", "_number")
    sizes = sizes.withColumns({"_number": number, "_weight": weight})
    sizes = sizes.withColumn("_cap", epochs * F.col("source_size"))
    sizes = sizes.withColumn("_full", F.col("_cap").cast("double") / F.col("_weight"))
    sizes = sizes.withColumns(
        {
            "_below": F.coalesce(F.sum("_cap").over(level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_weights": F.sum("_weight").over(level.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    # The words per weight if all sources before this one are full, and from where on that is not too much.
    sizes = sizes.withColumn("_rate", (F.lit(wanted) - F.col("_below")) / F.col("_weights"))
    rate = F.min(F.when(F.col("_rate") <= F.col("_full"), F.struct("_full", "_number", "_rate"))).over(Window.partitionBy())
    target = F.least(F.col("_cap").cast("double"), F.col("_weight") * F.coalesce(rate["_rate"], F.lit(math.inf)))
    return sizes.select("source", "source_size", "_number", target.alias("target"))


def _running(df: DataFrame, total: str, keys: list, order: list[str]) -> Column:
    """Sum of ``total`` over the rows before."""
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(total).over(window), F.lit(0))


def schedule(shares: DataFrame, n_slots: int) -> DataFrame:
    """Deal ``n_slots`` to sources (_number, share: blocks wanted): slot, _number, block (rank of the slot)."""
    spark = shares.sparkSession
    order = Window.orderBy("_number").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("share").over(Window.partitionBy())
    high = F.floor(F.sum("share").over(order) / total * _CIRCLE).cast("long")
    intervals = shares.withColumn("_high", high)
    low = F.coalesce(F.lag("_high").over(Window.orderBy("_number")), F.lit(0))
    intervals = intervals.withColumn("_low", low).where("_low < _high")
    cells = F.explode(F.sequence(F.floor(F.col("_low") / _CELL), F.floor((F.col("_high") - 1) / _CELL)))
    intervals = intervals.select("_number", "_low", "_high", cells.alias("_cell"))
    slots = spark.range(n_slots).withColumnRenamed("id", "slot")
    point = (F.col("slot") + 1) % _CIRCLE * _GOLDEN % _CIRCLE
    slots = slots.withColumn("_point", point).withColumn("_cell", F.floor(F.col("_point") / _CELL))
    dealt = slots.join(intervals, "_cell").where("_low <= _point AND _point < _high")
    dealt = dealt.select("slot", "_number", F.floor(F.col("slot") / _RUN).alias("_run"))
    runs = dealt.groupBy("_run", "_number").agg(F.count("*").alias("_n"))
    runs = runs.select("_run", "_number", _running(runs, "_n", ["_number"], ["_run"]).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_run", "_number").orderBy("slot")) - 1
    ranked = dealt.withColumn("_rank", within).join(runs, ["_run", "_number"])
    return ranked.select("slot", "_number", (F.col("_before") + F.col("_rank")).alias("block"))


def streams(docs: DataFrame, seed: int) -> DataFrame:
    """Place documents (doc_id, source, size) in their sources' shuffled streams: ``start``, words before them."""
    n_buckets = max(1, docs.count() // _BUCKET)
    shuffled = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("size").cast("string"))), 1, 15), 16, 10)
    docs = docs.withColumn("_key", shuffled.cast("long"))
    docs = docs.withColumn("_bucket", F.floor(F.col("_key") / ((1 << 60) // n_buckets + 1)))
    docs = docs.withColumn("_source", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")))
    sums = docs.groupBy("_source", "_bucket").agg(F.sum("size").alias("_n"))
    sums = sums.select("_source", "_bucket", _running(sums, "_n", ["_source"], ["_bucket"]).alias("_before"))
    within = _running(docs, "size", ["_source", "_bucket"], ["_key", "doc_id", "size"])
    docs = docs.withColumn("_within", within).join(sums, ["_source", "_bucket"])
    return docs.withColumn("start", F.col("_before") + F.col("_within")).drop(
        "_key", "_bucket", "_source", "_before", "_within"
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    epochs: int = 2,
    block_words: int | None = None,
    seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Mix ``docs`` (doc_id, source, text) to ``share`` times all their words.

    Returns the documents (doc_id, size, source_size, target, source, start) and the mix, a row per piece of
    a document in a block: slot (place in the mix), source, block, epoch, doc_id, start (of its document in
    the source), first_word (of the piece in the document), words. A source gives its target, rounded down.
    """
    sized = saved(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "mixing-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    wanted = share * total
    block = block_words or max(1, math.isqrt(int(wanted) // 1000))
    sources = saved(targets(sizes, wanted, list(weights), epochs), "mixing-sources")
    limit = F.floor("target").cast("long")
    share_of = F.ceil(F.col("_limit") / block).cast("long")
    limits = sources.withColumn("_limit", limit).withColumn("share", share_of)
    n_sources, n_slots = limits.agg(F.count("*"), F.coalesce(F.sum("share"), F.lit(0))).first()
    slots = schedule(limits.where("share > 0").select("_number", "share"), n_slots)

    placed = streams(sized, seed)
    known = placed.join(
        limits, placed["source"].eqNullSafe(limits["source"]), "inner"
    ).select(placed["*"], "source_size", "target", "_number", "_limit")
    known = saved(known, "mixing-documents")
    repeats = known.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    repeats = repeats.withColumn("_low", F.col("epoch") * F.col("source_size") + F.col("start"))
    repeats = repeats.withColumn("_high", F.least(F.col("_low") + F.col("size"), F.col("_limit"))).where("_low < _high")
    numbers = F.sequence(F.floor(F.col("_low") / block), F.floor((F.col("_high") - 1) / block))
    pieces = repeats.withColumn("block", F.explode(numbers))
    first = F.greatest(F.col("_low"), F.col("block") * block)
    words = F.least(F.col("_high"), (F.col("block") + 1) * block) - first
    pieces = pieces.withColumns({"first_word": first - F.col("_low"), "words": words})

    # The schedule can be a few slots short of a source's blocks; these follow after its end.
    dealt = slots.groupBy("_number").agg(F.count("*").alias("_dealt"))
    pieces = pieces.join(dealt, "_number", "left").join(slots, ["_number", "block"], "left")
    late = F.col("block") - F.coalesce(F.col("_dealt"), F.lit(0))
    slot = F.coalesce(F.col("slot"), n_slots + late * n_sources + F.col("_number"))
    mixed = pieces.select(
        slot.alias("slot"), "source", "block", "epoch", "doc_id", "start", "size", "first_word", "words"
    )
    return known.select("doc_id", "size", "source_size", "target", "source", "start"), mixed


def taken(known: DataFrame, mixed: DataFrame) -> DataFrame:
    """Documents with ``taken``, the words that the mix takes of each, repeats counted."""
    keys = ["source", "start", "doc_id", "size"]
    # Rows without words share a start, but never a piece.
    sums = mixed.groupBy(*keys).agg(F.sum("words").alias("taken"))
    same = F.lit(True)
    for key in keys:
        same &= known[key].eqNullSafe(sums[key])
    return known.join(sums, same, "left").select(
        known["*"], F.coalesce(sums["taken"], F.lit(0)).cast("long").alias("taken")
    )
