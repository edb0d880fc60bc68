"""Line deduplication within an edit distance, by a segment-partition join.

A line is dropped if an equal line, or one within ``edits`` edits, occurs before it: in a smaller doc_id, or
further up in the same text. Lines under ``min_chars`` code points are always kept.

Two lines within ``edits`` edits share one of ``edits + 1`` segments of the shorter at almost the same place. So
each distinct line is indexed by its segments, and probed with those of its substrings that can be such a
segment, for each length that is possible (multi-match-aware selection). Only hashes are shuffled: of the
segment, with its number and the indexed line's length, and of the line. Lines that share a hash are compared
by a banded bit-parallel edit distance; the texts of these few lines are fetched in a second pass over the
documents, which a bitmap of fixed size keeps small.

Groups of more than ``_SMALL`` lines with a segment in common are not paired. For one edit they are resolved
without pairs: lines that are equal but for the character at one place form a class, whose earliest member
drops the others, and a line less one character meets the line that equals it. For more edits such groups are
joined in full; Spark splits the large ones.

Rows that repeat a ``doc_id`` are read as one text for the order of lines. NULL texts stay NULL. Documents keep
their other columns, and stay even if no line is left (empty text). An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.llm.common import saved

#: Lines with a segment in common that are compared in pairs.
_SMALL = 32
#: Bits of the map of lines whose texts are fetched. At more lines it lets more through, but loses none.
_BITS = 1 << 23
#: Distinct lines that a task remembers, so as not to emit them again.
_SEEN = 200_000


def line_id(line: str, seed: int = 42) -> int:
    """Equals Spark's ``xxhash64`` of the line for the usual seed."""
    value = xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"), seed)
    return value - (1 << 64) if value >= 1 << 63 else value


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """Start and length of the ``edits + 1`` segments of a line, of nearly equal lengths."""
    short, longer = divmod(length, edits + 1)
    sizes = [short] * (edits + 1 - longer) + [short + 1] * longer
    return [(sum(sizes[:i]), size) for i, size in enumerate(sizes)]


def signatures(line: str, edits: int) -> Iterator[tuple[int, bool]]:
    """Hashes under which a line is indexed (True) and probed (False)."""
    length = len(line)
    for number, (start, size) in enumerate(segments(length, edits)):
        yield line_id(line[start : start + size], length * (edits + 1) + number), True
    for other in range(max(edits + 1, length - edits), length + 1):
        shift = length - other
        for number, (start, size) in enumerate(segments(other, edits)):
            left, right = number, edits - number
            low = max(0, start - left, start + shift - right)
            high = min(length - size, start + left, start + shift + right)
            for at in range(low, high + 1):
                yield line_id(line[at : at + size], other * (edits + 1) + number), False


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``: one bit vector per number of edits, cut to the band."""
    if abs(len(a) - len(b)) > edits:
        return False
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    # Bit i of state d: the first i characters of a match what was read of b with at most d edits.
    states = [(1 << (d + 1)) - 1 for d in range(edits + 1)]
    width = (1 << (2 * edits + 1)) - 1
    for j, c in enumerate(b, 1):
        band = width << (j - edits) if j > edits else width >> (edits - j)
        equal, older, fresh = places.get(c, 0), 0, 0
        for d, state in enumerate(states):
            new = (state & equal) << 1
            if d:
                new |= older | older << 1 | fresh << 1
            older, fresh = state, new & band
            states[d] = fresh
        if not states[-1]:
            return False
    return bool(states[-1] >> len(a) & 1)


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.where(F.length("line") >= min_chars)


def _candidates(docs: DataFrame, edits: int, min_chars: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of line ids to compare, and ids of lines in large groups."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            for begin in range(0, len(batch), 256):
                keys, ids, indexed = [], [], []
                for text in batch["text"].iloc[begin : begin + 256]:
                    for line in (text or "").split("\n"):
                        if len(line) >= min_chars and (own := line_id(line)) not in seen:
                            if len(seen) >= _SEEN:
                                seen.clear()
                            seen.add(own)
                            for key, index in set(signatures(line, edits)):
                                keys.append(key)
                                ids.append(own)
                                indexed.append(1 if index else 2)
                yield pd.DataFrame({"key": np.array(keys, np.int64), "id": np.array(ids, np.int64), "side": np.array(indexed, np.int32)})

    emitted = docs.select("text").mapInPandas(emit, "key long, id long, side int")
    members = emitted.repartition("key").groupBy("key", "id").agg(F.bit_or("side").alias("side"))
    groups = members.groupBy("key").agg(F.count("*").alias("n"), F.bit_or("side").alias("sides"))
    groups = groups.where("n > 1 AND sides = 3").select("key", "n")
    shared = saved(members.join(groups, "key"), "lines-shared")
    small = shared.where(F.col("n") <= _SMALL).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("id", "side"))).alias("m"))
    pairs = small.select(F.posexplode("m").alias("i", "a"), "m").select("a", F.explode(F.expr("slice(m, i + 2, size(m))")).alias("b"))
    met = (F.col("a.side").bitwiseAND(1) * F.col("b.side").bitwiseAND(2) + F.col("b.side").bitwiseAND(1) * F.col("a.side").bitwiseAND(2)) > 0
    pairs = pairs.where(met).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))
    large = shared.where(F.col("n") > _SMALL)
    if edits > 1:
        left = large.where("side & 1 = 1").select("key", F.col("id").alias("a"))
        right = large.where("side & 2 = 2").select("key", F.col("id").alias("b"))
        more = left.join(right, "key").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return saved(pairs.unionByName(more).distinct(), "lines-pairs"), large.select("id").limit(0)
    return saved(pairs.distinct(), "lines-pairs"), saved(large.select("id").distinct(), "lines-large")


def _texts(docs: DataFrame, ids: DataFrame, min_chars: int) -> DataFrame:
    """Distinct lines with one of ``ids``: id, line, digest, first (place of the first occurrence)."""
    slots = ids.select(F.pmod("id", F.lit(_BITS)).alias("slot")).selectExpr("slot DIV 64 AS at", "shiftleft(1L, CAST(slot % 64 AS INT)) AS bit")
    bits = slots.groupBy("at").agg(F.bit_or("bit").alias("b"))
    found = bits.collect()  # _BITS / 64 rows at most
    bitmap = np.zeros(_BITS // 64, np.int64)
    bitmap[[r["at"] for r in found]] = [r["b"] for r in found]
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("pos", T.IntegerType()), T.StructField("id", T.LongType()), T.StructField("line", T.StringType())])

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marked = shared.value.view(np.uint8)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                for pos, line in enumerate((text or "").split("\n")):
                    if len(line) >= min_chars:
                        own = line_id(line)
                        bit = own % _BITS
                        if marked[bit >> 3] >> (bit & 7) & 1:
                            rows.append((doc, pos, own, line))
            yield pd.DataFrame(rows, columns=schema.names)

    lines = docs.select("doc_id", "text").mapInPandas(fetch, schema)
    first = lines.groupBy("id", "line").agg(F.min(F.struct("doc_id", "pos")).alias("first"))
    return first.join(ids, "id", "left_semi").withColumn("digest", F.unhex(F.md5("line")))


def _near(docs: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """Digests of lines that come after one within ``edits`` edits."""
    pairs, large = _candidates(docs, edits, min_chars)
    ids = saved(pairs.select(F.explode(F.array("a", "b")).alias("id")).unionByName(large).distinct(), "lines-ids")
    texts = saved(_texts(docs, ids, min_chars), "lines-texts")

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([within(x, y, edits) for x, y in zip(a, b)], dtype=bool)

    order = F.struct("first", "digest").alias("order")
    left = texts.select(F.col("id").alias("a"), F.col("line").alias("a_line"), order.alias("a_order"))
    right = texts.select(F.col("id").alias("b"), F.col("line").alias("b_line"), order.alias("b_order"))
    compared = pairs.join(left, "a").join(right, "b").where(linked("a_line", "b_line"))
    dropped = compared.select(F.greatest("a_order", "b_order")["digest"].alias("digest"))

    def variants(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                line = row.line
                shorter = [line[:i] + line[i + 1 :] for i in range(len(line))]
                keys = [line_id(line)] + [line_id(s) for s in shorter] + [line_id(s, 1000 + i) for i, s in enumerate(shorter)]
                n = len(line)
                # 0: the line, 1: less a character, 2: less the character of a place.
                yield pd.DataFrame({"digest": [row.digest] * (2 * n + 1), "variant": keys, "size": [n] + [n - 1] * n + [n] * n, "kind": [0] + [1] * n + [2] * n})

    hot = texts.join(large, "id", "left_semi").select("digest", "line")
    keys = hot.mapInPandas(variants, "digest binary, variant long, size int, kind int").distinct()
    keys = saved(keys.join(texts.select("digest", order), "digest"), "lines-variants")
    # Least of the lines with a variant, and of the variants themselves.
    least = keys.groupBy("variant", "size", F.expr("kind = 2").alias("alike")).agg(
        F.min(F.when(F.col("kind") == 0, F.col("order"))).alias("whole"), F.min("order").alias("least")
    )
    joined = keys.withColumn("alike", F.expr("kind = 2")).join(least, ["variant", "size", "alike"])
    earlier = F.when(F.col("kind") == 1, F.col("whole")).otherwise(F.col("least"))
    more = joined.where(earlier < F.col("order")).select("digest")
    return saved(dropped.unionByName(more).distinct(), "lines-near")


def dedup_lines(docs: DataFrame, edits: int = 1, min_chars: int = 20) -> DataFrame:
    """Drop repeated lines from ``docs`` (doc_id, text and any other columns); adds nothing."""
    near = _near(docs, edits, min_chars)
    lines = _lines(docs, min_chars)
    digests = lines.select(F.unhex(F.md5("line")).alias("digest"), F.xxhash64("line").alias("id"), "doc_id", "pos")
    first = digests.groupBy("digest", "id").agg(F.min(F.struct("doc_id", "pos")).alias("first"))
    first = first.join(near, "digest", "left_anti")
    kept = first.groupBy(F.col("first.doc_id").alias("_doc")).agg(F.collect_list(F.struct("first.pos", "id")).alias("_kept"))

    @F.pandas_udf("string")
    def rebuilt(texts: pd.Series, kept: pd.Series) -> pd.Series:
        out = []
        for text, own in zip(texts, kept):
            if text is not None:
                places = {(k["pos"], k["id"]) for k in own} if own is not None else set()
                lines = enumerate(text.split("\n"))
                text = "\n".join(x for i, x in lines if len(x) < min_chars or (i, line_id(x)) in places)
            out.append(text)
        return pd.Series(out, dtype=object)

    joined = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_doc"]), "left")
    text: Column = rebuilt(docs["text"], kept["_kept"]).alias("text")
    return joined.select(*[text if name == "text" else docs[f"`{name}`"] for name in docs.columns])
