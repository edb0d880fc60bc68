"""How the vocabulary of each source departs from its language and from the other sources, by count cells.

Terms are runs of ASCII letters and of anything beyond ASCII, with A-Z in lower case. A language keeps the terms
that enough of its documents hold. A term's share in a source is the integer ``p = 1 + floor(S (n + 2) / (N + 2 V))``
of its count, and the divergence of two shares is ``f = floor((p - q)^2 / (p + q))``.

f depends on a term through its two counts only. Terms are therefore counted by cell (count here, count there),
and f is evaluated once a cell:

- Sources against their language: the ten best values of a source are found among its cells; equal values are
  merged, their multiplicities added up from the best value down, and only cells that reach the first ranks are
  expanded into terms, in UTF-8 order.
- Sources against each other: cells are made of terms that both hold. What only one holds, or neither, follows
  from the cells of each source alone: a term in both adds ``f(a,b) - f(a,0) - f(0,b) + f(0,0)`` to the sum
  over what each source holds against nothing, so absent terms are never written out.

Tasks count terms in a dictionary of bounded size and hand on partial sums, so a hot source or a frequent term
shuffles a row per task and not one per occurrence. All arithmetic is on integers, wide ones where a product could
pass 64 bits.

NULL in text, lang or source counts as an empty string. Rows are documents, whatever their ids, so repeated rows
count each. A (lang, source) group without terms has its pairs, and no term rows. Equal values are ranked by
item. An empty table gives no rows, and other columns are dropped.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import pieces, saved

#: Shares are integers on this scale.
SCALE = 1_000_000_000
#: Counts that a task keeps before it hands them on.
_HELD = 400_000

_SEPARATE = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))

_COUNTS = "lang string, source string, term string, n long, docs long"


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in lists of bounded size."""
    for piece in pieces(text.encode("utf-8", "surrogatepass").translate(_SEPARATE)):
        yield piece.split(b" ")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[str, str], Counter] = defaultdict(Counter)
    holders: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def emit() -> Iterator[pa.RecordBatch]:
        for group, counts in found.items():
            counts.pop(b"", None)
            held = holders[group]
            listed = list(counts)
            for i in range(0, len(listed), 20_000):
                part = listed[i : i + 20_000]
                columns = [[group[0]] * len(part), [group[1]] * len(part), [t.decode("utf-8", "surrogatepass") for t in part]]
                columns += [[counts[t] for t in part], [held[t] for t in part]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["lang", "source", "term", "n", "docs"])
        found.clear()
        holders.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            own: set[bytes] = set()
            for part in terms(text):
                found[lang, source].update(part)
                own.update(part)
            holders[lang, source].update(own)
        if sum(map(len, found.values())) > _HELD:
            yield from emit()
    yield from emit()


def term_counts(docs: DataFrame) -> DataFrame:
    """Occurrences (n) and documents (docs) of each term in each (lang, source)."""
    read = docs.select(*[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source", "text")])
    partial = read.mapInArrow(_count, _COUNTS)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str, terms_: str) -> str:
    """SQL of a share; the total is 0 only where a language keeps no term."""
    wide = f"CAST({count} + 2 AS DECIMAL(20, 0)) * CAST({SCALE} AS DECIMAL(10, 0))"
    return f"(1 + {wide} DIV greatest(1, {total} + 2 * {terms_}))"


def _divergence(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) DIV ({p} + {q}))"


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Each (lang, source): total (count of kept terms), lang_total, v (kept terms of the language)."""
    name = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    lang = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang")
    lang = lang.agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("v"))
    known = docs.select(*name).distinct().join(totals, ["lang", "source"], "left").join(lang, "lang", "left")
    return known.na.fill(0, ["total", "lang_total", "v"])


def best_terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The terms of each source that exceed their language's share the most: lang, source, item, value, rank."""
    cells = kept.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("m")).join(groups, ["lang", "source"])
    shares = cells.withColumn("p", F.expr(_share("n", "total", "v"))).withColumn("q", F.expr(_share("lang_n", "lang_total", "v")))
    cells = shares.where("p > q").withColumn("value", F.expr(_divergence("p", "q")))
    merged = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    downwards = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # A value has one term at least, so no more values than ranks are needed; tasks find their best before the shuffle.
    first = merged.withColumn("place", F.row_number().over(downwards)).where(F.col("place") <= top)
    before = F.coalesce(F.sum("m").over(downwards.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = first.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value", "before")
    opened = cells.join(reached, ["lang", "source", "value"]).select("lang", "source", "n", "lang_n", "value", "before")
    listed = kept.join(opened, ["lang", "source", "n", "lang_n"])
    within = F.row_number().over(Window.partitionBy("lang", "source", "value", "before").orderBy("term"))
    listed = listed.withColumn("within", within).where(F.col("within") <= top)
    rank = (F.col("before") + F.col("within")).cast("int").alias("rank")
    return listed.select("lang", "source", F.col("term").alias("item"), "value", rank).where(F.col("rank") <= top)


def pair_divergences(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Divergence of each two sources of a language over all its kept terms: lang, source, item, value, rank."""
    of = groups.select("lang", "source", "total", "v")
    left = of.selectExpr("lang", "source AS a", "total AS a_total", "v")
    right = of.selectExpr("lang", "source AS b", "total AS b_total")
    both = left.join(right, "lang").where("a < b")
    for side in ("a", "b"):
        both = both.withColumn(f"{side}_0", F.expr(_share("0L", f"{side}_total", "v")))
    both = both.withColumn("nothing", F.expr(_divergence("a_0", "b_0")))

    # Terms that both hold: the sources of a term are no more than the language has.
    held = kept.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("held"))
    one = held.select("lang", "held", F.posexplode("held").alias("at", "x"))
    two = one.select("lang", "x", F.explode(F.expr("slice(held, at + 2, size(held))")).alias("y"))
    joint = two.selectExpr("lang", "x.source AS a", "y.source AS b", "x.n AS a_n", "y.n AS b_n")
    joint = joint.groupBy("lang", "a", "b", "a_n", "b_n").agg(F.count("*").alias("m")).join(both, ["lang", "a", "b"])
    joint = joint.withColumn("p", F.expr(_share("a_n", "a_total", "v"))).withColumn("q", F.expr(_share("b_n", "b_total", "v")))
    gain = f"m * ({_divergence('p', 'q')} - {_divergence('p', 'b_0')} - {_divergence('a_0', 'q')} + nothing)"
    parts = [joint.selectExpr("lang", "a", "b", f"{gain} AS part"), both.selectExpr("lang", "a", "b", "v * nothing AS part")]

    # What a source holds, against nothing.
    alone = kept.groupBy("lang", "source", "n").agg(F.count("*").alias("m"))
    for side, other in (("a", "b"), ("b", "a")):
        own = alone.withColumnRenamed("source", side).join(both, ["lang", side]).withColumn("p", F.expr(_share("n", f"{side}_total", "v")))
        parts.append(own.selectExpr("lang", "a", "b", f"m * ({_divergence('p', f'{other}_0')} - nothing) AS part"))
    added = parts[0]
    for part in parts[1:]:
        added = added.unionByName(part)
    # A divergence is the same from both sides.
    values = added.groupBy("lang", "a", "b").agg(F.sum("part").cast("long").alias("value"))
    sides = F.explode(F.expr("array(struct(a AS source, b AS item), struct(b AS source, a AS item))")).alias("side")
    values = values.select("lang", "value", sides).select("lang", "side.source", "side.item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return values.withColumn("rank", rank)


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """Rows lang, source, part, item, value, rank.

    Part ``pair`` ranks the other sources of the language by divergence, part ``term`` the ``top`` terms that the
    source uses more than its language. Kept are terms in ``min_docs`` documents of a language.
    """
    counts = saved(term_counts(docs), "divergence-counts")
    known = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    known = known.where(F.col("docs") >= min_docs).drop("docs")
    kept = saved(counts.drop("docs").join(known, ["lang", "term"]), "divergence-kept")
    groups = saved(_groups(docs, kept), "divergence-groups")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = pair_divergences(kept, groups).withColumn("part", F.lit("pair"))
    best = best_terms(kept, groups, top).withColumn("part", F.lit("term"))
    return pairs.select(*columns).unionByName(best.select(*columns))
