"""Documents to packed training sequences: five stages, each on all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
``run`` writes each stage's result to the shared folder and reads it again as the next stage's documents. So a
stage begins by removing the intermediate tables of those before it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import jaccard_join, line_dedup, mixing, packing, weak_quality
from tollgate.llm.common import discard, documents, saved, ship


def _begin(spark: SparkSession) -> None:
    ship(spark)
    discard(spark)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality model or its base rule rejects."""
    _begin(spark)
    return weak_quality.score(docs).where("kept").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that occur before; a document stays, with the lines that are left."""
    _begin(spark)
    left = line_dedup.dedup_lines(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of near-duplicates the document with the least id, with all rows of that id."""
    _begin(spark)
    found = jaccard_join.near_duplicates(docs)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents: one row for each time that the mix takes at least half of a document.

    Rows are in the order of the mix: a copy lies where the mix has its first piece of that epoch. Rows of one
    doc_id count as one document. Documents without words are in no mix.
    """
    _begin(spark)
    known, mixed = mixing.mix(docs)
    place = F.min(F.struct("slot", "start")).alias("place")
    passes = saved(mixed.groupBy("doc_id", "epoch").agg(place, F.sum("words").alias("words")), "mix-passes")
    # As many passes as copies have pieces, the earliest epochs.
    listed = F.array_sort(F.collect_list(F.struct("epoch", "place")))
    taken = passes.groupBy("doc_id").agg(F.sum("words").alias("taken"), listed.alias("passes"))
    sizes = known.groupBy(F.col("doc_id").alias("_doc")).agg(F.sum("size").alias("size"))
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    of = taken.join(sizes, taken["doc_id"].eqNullSafe(sizes["_doc"])).withColumn("_copies", copies).where("_copies > 0")
    of = saved(of.select("_doc", F.expr("slice(passes, 1, _copies).place").alias("_places")), "mix-copies")
    joined = docs.join(of, docs["doc_id"].eqNullSafe(of["_doc"]))
    repeated = joined.withColumn("_place", F.explode("_places"))
    # Rows of one doc_id share their place.
    order = ["_place.slot", "_place.start", "doc_id"]
    return repeated.repartitionByRange(*order).sortWithinPartitions(*order).select(*[docs[f"`{name}`"] for name in docs.columns])


def _in_written_order(docs: DataFrame) -> DataFrame:
    """Rows of written files in the order in which they were written; Spark reads large files first.

    Rows that are in no files keep the order of their partitions.
    """
    part = F.regexp_extract("_metadata.file_name", r"part-([0-9]+)", 1).try_cast("long").alias("_part")
    try:
        placed = docs.select(*[F.col(f"`{name}`") for name in docs.columns], part, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return docs
    order = ["_part", "_file", "_row"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).drop(*order)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the mix, in its order, into sequences of 4096 tokens; a row per piece of a document."""
    _begin(spark)
    return packing.pack(_in_written_order(docs), public_tokenizers.path("word_bpe_49k.json"), 2)


STAGES = [
    ("quality_rules", quality_rules),
    ("dedup_lines", dedup_lines),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: Tokenizers and learnt weights have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
