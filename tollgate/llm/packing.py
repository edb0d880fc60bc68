"""Packing whose windows hold every source in a set proportion.

Each source is a queue of its documents' tokens. A window goes round the queues and takes from each what its
quantum (its share of the window) and the deficit carried from the windows before allow. A deficit is the
exact share so far less the tokens had so far, so it can be computed for any window without those before
it: a token's due time is its place in its queue over the queue's length, and the first ``k`` windows hold the
tokens that are due first. Tasks work on any part of the queues and agree on every cut; deficits so pass over
windows and partitions alike, and no window differs from its target by more than a token per source and end.

A window is a run of sequences; all sequences are full but the very last. Queues are ordered by input
partition and row. NULL texts count as empty (one end id), NULL sources are a source, other columns are
dropped, an empty table gives no rows. Rows that repeat a ``doc_id`` are packed as documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.llm.common import saved
from tollgate.llm.encoding import encoder

_CHUNK = 256
#: Windows whose cuts are computed at once.
_BLOCK = 64


def cuts(lengths: np.ndarray, window: int, windows: np.ndarray) -> np.ndarray:
    """Tokens that each queue has given before each of ``windows``: (windows, queues).

    ``lengths``: positive lengths of the queues. The first ``k`` tokens by (due time, queue) are taken.
    """
    total = int(lengths.sum())
    k = np.minimum(windows.astype(object) * window, total).astype(np.int64)
    taken = np.floor(lengths[None, :].astype(np.longdouble) * (k[:, None] / np.longdouble(total))).astype(np.int64)
    taken = np.clip(taken, 0, lengths)
    rows, last = np.arange(len(k)), len(lengths) - 1

    def due(at):
        return (at + 0.5) / lengths

    while True:
        after = np.where(taken < lengths, due(taken), np.inf)
        before = np.where(taken > 0, due(taken - 1), -np.inf)
        first = after.argmin(1)
        final = last - before[:, ::-1].argmax(1)
        short = k - taken.sum(1)
        low, high = after[rows, first], before[rows, final]
        swap = (short == 0) & ((high > low) | ((high == low) & (final > first)))
        give, back = (short > 0) | swap, (short < 0) | swap
        if not (give | back).any():
            return taken
        taken[rows[give], first[give]] += 1
        taken[rows[back], final[back]] -= 1


class _Plan:
    """Cuts of the windows that a task meets."""

    def __init__(self, lengths: list[int], window: int):
        self.lengths, self.window = np.array(lengths, np.int64), window
        self._blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Cuts at the windows of a block, and where each queue begins within a window."""
        if number not in self._blocks:
            if len(self._blocks) > 256:
                self._blocks.clear()
            taken = cuts(self.lengths, self.window, np.arange(number * _BLOCK, (number + 1) * _BLOCK + 1))
            each = np.diff(taken, axis=0)
            self._blocks[number] = taken, np.cumsum(each, 1) - each
        return self._blocks[number]

    def pieces(self, queue: int, start: int, length: int) -> list[tuple[int, int, int, int]]:
        """A run of tokens of a queue as (offset in the run, length, window, place in the window)."""
        total, own = int(self.lengths.sum()), int(self.lengths[queue])
        window = max(0, start * total // own // self.window - 2)
        out, at, end = [], start, start + length
        while at < end:
            taken, places = self.block(window // _BLOCK)
            low, high = int(taken[window % _BLOCK, queue]), int(taken[window % _BLOCK + 1, queue])
            if low > at:
                window -= 1
            elif high <= at:
                window += 1
            else:
                stop = min(end, high)
                out.append((at - start, stop - at, window, int(places[window % _BLOCK, queue]) + at - low))
                at = stop
        return out


def pack(
    docs: DataFrame, vocabulary: str, end_id: int, sequence: int = 4096, sequences_per_window: int = 16
) -> DataFrame:
    """Pack ``docs`` (doc_id, source, text) into sequences of ``sequence`` tokens.

    Returns a row per piece: doc_id, start (ids of its document before it), ids (uint32, little-endian),
    doc_tokens, sequence_id, offset (in the sequence), padded (length of its sequence with padding). A
    sequence is padded to ``sequence``, unless its length is a power of two. Windows fill with every
    source's tokens in the proportion of all its tokens.
    """
    spark, doc_id = docs.sparkSession, docs.schema["doc_id"].dataType
    encoded_schema = T.StructType(
        [T.StructField("doc_id", doc_id)]
        + [T.StructField(n, t) for n, t in (("queue", T.StringType()), ("part", T.IntegerType()), ("place", T.LongType()), ("n_tokens", T.LongType()), ("ids", T.BinaryType()))]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own, filled = TaskContext.get().partitionId(), encoder(vocabulary, end_id), {}
        for whole in batches:
            for begin in range(0, whole.num_rows, _CHUNK):
                batch = whole.slice(begin, _CHUNK)
                ids, bounds = own.encode(batch.column("text").to_pylist())
                ids, counts = ids.astype("<u4"), np.diff(bounds)
                queues, places = batch.column("queue").to_pylist(), []
                for queue, count in zip(queues, counts.tolist()):
                    places.append(filled.get(queue, 0))
                    filled[queue] = places[-1] + count
                narrow = ids.astype("<u2") if ids.max(initial=0) < 1 << 16 else ids
                blobs = [narrow[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), batch.column("queue"), pa.array([part] * len(blobs), pa.int32()),
                        pa.array(places, pa.int64()), pa.array(counts, pa.int64()), pa.array(blobs, pa.binary()),
                    ],
                    encoded_schema.names,
                )

    queue = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("queue")
    encoded = saved(docs.select("doc_id", queue, "text").mapInArrow(encode, encoded_schema), "packing")
    filled = encoded.groupBy("queue", "part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = saved(filled.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "packing-bases")
    # A row per source comes to the driver.
    totals = sorted((row.queue, row.n) for row in bases.groupBy("queue").agg(F.sum("n").alias("n")).collect())
    numbers, lengths = {q: i for i, (q, _) in enumerate(totals)}, [n for _, n in totals]
    total, window = sum(lengths), sequence * sequences_per_window
    names = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset", "padded"]
    kinds = [doc_id, T.LongType(), T.BinaryType(), T.LongType(), T.LongType(), T.LongType(), T.LongType()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = _Plan(lengths, window)
        for whole in batches:
            for begin in range(0, whole.num_rows, _CHUNK):
                batch = whole.slice(begin, _CHUNK)
                out: list[list] = [[] for _ in names]
                columns = [batch.column(c).to_pylist() for c in ("queue", "start", "n_tokens", "ids")]
                for row, (name, start, count, blob) in enumerate(zip(*columns)):
                    ids = np.frombuffer(blob, "<u2" if len(blob) == 2 * count else "<u4").astype("<u4")
                    for at, length, number, place in plan.pieces(numbers[name], start, count):
                        while length:
                            index, offset = divmod(place, sequence)
                            n = min(length, sequence - offset)
                            number_of = number * sequences_per_window + index
                            left = min(sequence, total - number_of * sequence)
                            padded = left if left & (left - 1) == 0 else sequence
                            piece = (row, at, ids[at : at + n].tobytes(), count, number_of, offset, padded)
                            for values, value in zip(out, piece):
                                values.append(value)
                            at, place, length = at + n, place + n, length - n
                taken = batch.column("doc_id").take(pa.array(out[0], pa.int64()))
                arrays = [taken] + [pa.array(v, pa.binary() if n == "ids" else pa.int64()) for n, v in zip(names[1:], out[1:])]
                yield pa.RecordBatch.from_arrays(arrays, names)

    placed = encoded.join(bases.select("queue", "part", "base"), ["queue", "part"])
    placed = placed.select("doc_id", "queue", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids")
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])
    return placed.mapInArrow(cut, schema)
