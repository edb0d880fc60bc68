"""Importance resampling towards a target distribution of hashed n-grams, from running CRCs.

A feature is a run of words joined by single spaces, and its bucket the CRC-32 of its bytes. A document is brought
into that form once (A-Z in lower case, separators one space) and scanned once: the CRC of everything before and
after each word is stored. CRC is linear over GF(2), ``crc(xy) = shift(crc(x), |y|) ^ crc(y)``, so the CRC of any
run follows from those of two prefixes, ``crc(y) = crc(xy) ^ shift(crc(x), |y|)``, however long the run is. The
shift by a number of bytes is a 32 x 32 matrix over GF(2); those of powers of two are tables, and numpy applies
them to all features of a piece at once.

Bucket counts of the corpus and of the target texts (two arrays of fixed size) give each bucket's gain in
thousandths of a nat. A document's weight is the floored mean of its features' gains; with Gumbel noise from a hash of
its id, the highest scores are a sample without replacement by weight. Texts are read twice and never shuffled.

Ranks come from counts by score, which are whole numbers of a narrow range: the rank of a row is the number of
rows with higher scores and its place among equals, by doc_id. The noise spreads rows over thousands of scores, so
one score holds less than a thousandth of all rows, copies included.

NULL texts and texts without words have no features and weight 0. A NULL doc_id is hashed as an empty text and comes
first among equals. Rows that repeat a doc_id are documents of their own. An empty table gives no rows; without
target texts every gain compares with empty counts. Other columns are dropped.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.llm.common import pieces, saved

#: Fixed value: the reflected polynomial of CRC-32.
_POLYNOMIAL = 0xEDB88320

_WORD_BYTES = bytes(
    b if b >= 0x80 or 0x61 <= b <= 0x7A or 0x30 <= b <= 0x39 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = table[0][crc & np.uint32(255)]
    for i in (1, 2, 3):
        out = out ^ table[i][(crc >> np.uint32(8 * i)) & np.uint32(255)]
    return out


def _shift_tables(levels: int) -> list[np.ndarray]:
    """For each power of two, the shift by so many zero bytes: its image of each byte in each of four places."""
    low = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        low = (low >> np.uint32(1)) ^ np.where(low & np.uint32(1), np.uint32(_POLYNOMIAL), np.uint32(0))
    places = np.arange(256, dtype=np.uint32)
    tables = [np.stack([low] + [places << np.uint32(8 * i) for i in range(3)])]
    while len(tables) < levels:
        last = tables[-1]
        tables.append(np.stack([_apply(last, row) for row in last]))  # twice the shift
    return tables


_SHIFTS = _shift_tables(40)


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs followed by ``length`` zero bytes, without the conditioning of the first and last step."""
    out = crc.copy()
    for level in range(int(length.max()).bit_length() if len(length) else 0):
        chosen = np.flatnonzero((length >> level) & 1)
        out[chosen] = _apply(_SHIFTS[level], out[chosen])
    return out


class Prefixes:
    """Running CRCs of a normalised text, at the beginning and end of each word, with their places."""

    def __init__(self, words: list[bytes]):
        crc, begins, ends = 0, [], []
        for word in words:
            begins.append(crc)
            crc = crc32(word, crc)
            ends.append(crc)
            crc = crc32(b" ", crc)
        size = np.fromiter(map(len, words), np.int64, len(words))
        self.begin, self.end = np.array(begins, np.uint32), np.array(ends, np.uint32)
        self.stop = np.cumsum(size + 1) - 1
        self.start = self.stop - size

    def runs(self, n: int) -> np.ndarray:
        """CRCs of all runs of ``n`` words."""
        count = max(0, len(self.stop) - n + 1)
        end, begin = self.end[len(self.end) - count :], self.begin[:count]
        return end ^ shifted(begin, self.stop[len(self.stop) - count :] - self.start[:count])


def _word_lists(text: str | None, overlap: int) -> Iterator[list[bytes]]:
    """A text's words in lists of bounded size; each begins with the last ``overlap`` words of the one before."""
    tail: list[bytes] = []
    for piece in pieces((text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES)):
        if words := tail + piece.split():
            yield words
            tail = words[max(0, len(words) - overlap) :] if overlap else []


def buckets_of(text: str | None, longest: int, buckets: int) -> Iterator[np.ndarray]:
    """Buckets of all features of a text, in arrays of bounded size."""
    known = 0  # words that begin a list and have been in the one before
    for words in _word_lists(text, longest - 1):
        prefixes = Prefixes(words)
        for n in range(1, longest + 1):
            crcs = prefixes.runs(n)
            # Runs that lie within the repeated words were counted with the list before.
            yield crcs[max(0, known - n + 1) :] % np.uint32(buckets)
        known = min(longest - 1, len(words))


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Features in each bucket, added up in tasks; the driver gets an array of fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for found in buckets_of(text, longest, buckets):
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["bucket", "n"])

    partial = texts.select(F.col("text").cast("string")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket at most
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of a nat by which a bucket is more likely in the target, one added to each count."""
    n, every, wanted = len(corpus), int(corpus.sum()), int(target.sum())
    ratios = [((t + 1) * (every + n)) / ((s + 1) * (wanted + n)) for s, t in zip(corpus.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def _noise(doc_id: str | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{doc_id or ''}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, longest: int, seed: int) -> DataFrame:
    """Each document's doc_id, n_words, n_features, weight and score."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight", "score"))])
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for name, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                total = n_features = n_words = 0
                for i, found in enumerate(buckets_of(text, longest, len(gain))):
                    total += int(gain[found].sum())
                    n_features += len(found)
                    n_words += len(found) if i % longest == 0 else 0
                weight = total // n_features if n_features else 0
                out.append((n_words, n_features, weight, weight + _noise(name, seed)))
            columns = [pa.array(c, pa.int64()) for c in zip(*out)] or [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    return docs.select("doc_id", F.col("doc_id").cast("string").alias("name"), F.col("text").cast("string")).mapInArrow(weigh, schema)


def _ranked(rows: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """Add ``rank``: the place by score of the drawn rows, NULL for the others."""
    rows = rows.withColumn("_eligible", eligible)
    # One row for each different score; scores are whole numbers of a range that the logarithms bound.
    downwards = Window.orderBy(F.desc("score"))
    counts = rows.where("_eligible").groupBy("score").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(downwards.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    drawn = F.expr(f"{percent} * sum(_n) OVER () DIV 100")
    reached = counts.select(F.col("score").alias("_score"), before.alias("_before"), drawn.alias("_drawn")).where("_before < _drawn")
    placed = rows.join(reached, F.col("_eligible") & (F.col("score") == F.col("_score")), "left")
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "n_features", "weight")]
    within = F.row_number().over(Window.partitionBy("score", "_eligible").orderBy(*order))
    rank = F.when(F.col("_before").isNotNull(), F.col("_before") + within)
    return placed.withColumn("rank", F.when(rank <= F.col("_drawn"), rank).cast("long")).drop("_eligible", "_score", "_before", "_drawn")


def resample(
    docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, percent: int = 10, least: int = 20, seed: int = 2024
) -> DataFrame:
    """Draw ``percent`` of the documents with ``least`` words or more: doc_id, n_features, weight, score, rank.

    ``docs`` has doc_id and text, ``target`` has text. Features are runs of one to ``longest`` words.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    rows = saved(scored(docs, gain, longest, seed), "resampling-scores")
    return _ranked(rows, F.col("n_words") >= least, percent).drop("n_words")
