"""Exact top-k inner products over vectors in order of descending length.

A slab holds vectors of about equal length, longest first, and queries come in groups; a task takes a slab and a
group at a time. A query is skipped in a slab if (the longest vector) x (the query) is below the query's bound. Vectors
are rotated by the right singular vectors of all vectors, which gathers most of an inner product in the first
coordinates, and a vector is skipped if its partial product over these plus the Cauchy-Schwarz bound on the rest is below:
the product of what is left of both lengths. That product is one more coordinate, and the bound another, so one
matrix product of a tile tells what remains. How many coordinates it takes is chosen on a few pairs of each slab and
group; if too few pairs are skipped, the matrix product is of all integers as they are, and its scores are exact.

The bound is the k-th best score and its id among longer vectors, which earlier passes find, and rises with what a slab
has. Each pass searches several times as many slabs as those before it. Scores equal to the bound are kept if their id is
smaller. The vectors of a slab are in order of their ids, so that a tile of larger ids needs a higher score, and a
large group of equal vectors costs no more than others.

Every slab meets every group in a product of the two tables without a shuffle, so all that is shuffled is the vectors
once and the best of each slab.

Vectors that are NULL or hold NULL or non-finite components take no part. Shorter vectors count as padded with
zeros. Rows that repeat an id are vectors of their own. An empty table gives no rows. Sums that pass 64 bits
wrap around.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import saved

#: Vectors in a slab, and queries in a group; fewer if they are wider than 64.
_SLAB, _QUERIES = 32_768, 16_384
#: Queries and vectors of a tile, whose products are held at once.
_TILE = 512, 512
#: A pass searches up to so many times the slabs of the passes before it.
_PASS = 8
#: Coordinates of a pair in a matrix product that cost as much as a pair that it does not skip.
_KEPT = 8000
#: The score and id that all others are better than.
_LEAST, _LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def quantized(vectors: DataFrame, vector_id: str, column: str, scale: float) -> DataFrame:
    """Usable vectors as (vec_id, v): integers ``floor(scale * x)``."""
    x = F.col(column)
    finite = ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    kept = vectors.where(x.isNotNull()).where(F.coalesce(finite, F.lit(False)))
    v = F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long"))
    return kept.select(F.col(vector_id).cast("long").alias("vec_id"), v.alias("v"))


def _rows(most: int, width: int) -> int:
    return max(1, most * 64 // max(width, 64))


def _matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    sizes, values = vectors.value_lengths().to_numpy(), vectors.flatten().to_numpy()
    if (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _packed(matrix: np.ndarray) -> bytes:
    """Integers in as few bytes each as hold them all."""
    least, most = matrix.min(), matrix.max()
    kind = next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= least and most <= np.iinfo(t).max)
    return matrix.astype(kind).tobytes()


def _unpacked(data: pa.Scalar, rows: int, width: int) -> np.ndarray:
    data = data.as_buffer()
    return np.frombuffer(data, f"i{data.size // (rows * width)}").reshape(rows, width)


def _set(mask: np.ndarray) -> np.ndarray:
    """Where a mask is set, in any order; fast if that is in few places."""
    if len(mask) % 64:
        return np.flatnonzero(mask)
    words = mask.view(np.uint64).reshape(8, -1)
    some = np.flatnonzero(np.bitwise_or.reduce(words, axis=0) != 0)
    row, column = np.nonzero(words[:, some])
    word = row * words.shape[1] + some[column]
    row, column = np.nonzero(mask.reshape(-1, 8)[word])
    return 8 * word[row] + column


def _tables(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows in tables of ``most`` rows, and what is left."""
    held = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, part]) if held else part
        while held.num_rows >= most:
            yield held.slice(0, most)
            held = held.slice(most)
    if held:
        yield held


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors, from the Gram matrix that tasks add up."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column(0), width).astype(np.float64)
            total += m.T @ m
        yield pa.RecordBatch.from_pydict({"row": pa.array(range(width), pa.int32()), "g": list(total)})

    summed = vectors.select("v").mapInArrow(gram, "row int, g array<double>").select("row", F.posexplode("g"))
    rows = summed.groupBy("row", "pos").agg(F.sum("col").alias("g")).collect()  # width x width numbers
    whole = np.zeros((width, width))
    for row in rows:
        whole[row.row, row.pos] = row.g
    return np.ascontiguousarray(np.linalg.eigh(whole)[1][:, ::-1])


class _Slab:
    """Vectors in order of their ids, to be searched for the best of queries."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, longest: float, basis: np.ndarray, k: int):
        self.ids, self.m, self.longest, self.basis, self.k = ids, m, longest, basis, k
        # Lengths of whole numbers are 0 or at least 1.
        self.width, self.unit, self.chosen = m.shape[1], max(longest, 1), None

    def turned(self, m: np.ndarray, lengths: np.ndarray | float, head: int) -> tuple[np.ndarray, np.ndarray]:
        out = m @ self.basis
        out /= lengths
        return out[:, :head], np.linalg.norm(out[:, head:], axis=1, keepdims=True)

    def form(self, q: np.ndarray, lengths: np.ndarray, needed: np.ndarray, kind: type | None) -> tuple[int, np.ndarray]:
        """The cheapest form for a search of queries like these, and the vectors as a matrix product takes them.

        That is ``head`` coordinates and the length of the rest, or 0 and all integers as they are; then 1 for the bound.
        """
        if self.chosen:
            return self.chosen
        some, at = slice(None, None, -(-len(q) // 128)), slice(None, None, -(-len(self.m) // 512))
        a, _ = self.turned(q[some], lengths[some], self.width)
        b, _ = self.turned(self.m[at], self.unit, self.width)
        costs = {0: (self.width + 1) * (2 if kind is np.float64 else 1)} if kind else {}
        for head in sorted({-(-self.width * i // 16) for i in range(1, 16 if kind else 17)}):
            rest = np.outer(np.linalg.norm(a[:, head:], axis=1), np.linalg.norm(b[:, head:], axis=1))
            kept = np.mean(a[:, :head] @ b[:, :head].T + rest >= needed[some])
            costs[head] = head + 2 + _KEPT * kept
        head = min(costs, key=costs.get)
        columns = [*self.turned(self.m, self.unit, head)] if head else [self.m]
        kind = np.float32 if head else kind
        self.chosen = head, np.hstack([*columns, np.ones((len(self.m), 1))], dtype=kind, casting="unsafe")
        return self.chosen

    def scores(self, q: np.ndarray, which: np.ndarray, at: np.ndarray, kind: type | None) -> np.ndarray:
        """Exact products of pairs."""
        step, out = 1 << 16, [np.zeros(0, np.int64)]
        for i in range(0, len(which), step):
            a, b = q[which[i : i + step]], self.m[at[i : i + step]]
            out.append(np.einsum("ij,ij->i", a.astype(kind or np.int64), b.astype(kind or np.int64)).astype(np.int64))
        return np.concatenate(out)

    def best(
        self, asked: np.ndarray, q: np.ndarray, bounds: np.ndarray, bound_ids: np.ndarray
    ) -> Iterator[tuple[np.ndarray, ...]]:
        """The best vectors of queries that are better than their bounds: query ids, vector ids and scores."""
        lengths = np.linalg.norm(q.astype(np.float64), axis=1)
        alive = lengths * self.longest * (1 + 1e-9) >= bounds
        asked, q, lengths, bounds, bound_ids = (x[alive] for x in (asked, q, lengths, bounds, bound_ids))
        # Sums of some of the products, less a bound, stay under twice the product of the lengths: exact below 2**24 or 2**53.
        largest = lengths.max(initial=0) * self.longest
        kind = np.float32 if largest < 2**22 else np.float64 if largest < 2**51 else None
        for i in range(0, len(q), _TILE[0]):
            part = slice(i, i + _TILE[0])
            yield self._best(asked[part], q[part], np.maximum(lengths[part, None], 1), bounds[part], bound_ids[part], kind)

    def _best(self, asked, q, lengths, bounds, bound_ids, kind):  # noqa: ANN001, ANN202
        n, k = len(q), self.k
        tops, top_ids = np.full((n, k), _LEAST), np.full((n, k), _LAST)
        found: list[tuple[np.ndarray, ...]] = []
        n_found, form, out, mask = 0, None, None, None

        def settle() -> None:
            """Take the pairs found so far into the best of each query, and raise the bounds."""
            nonlocal bounds, bound_ids
            which, at, *score = (np.concatenate(x) for x in zip(*found))
            found.clear()
            score, ids = score[0] if score else self.scores(q, which, at, kind), self.ids[at]
            better = (score > bounds[which]) | ((score == bounds[which]) & (ids < bound_ids[which]))
            better &= ids != asked[which]
            which, ids, score = which[better], ids[better], score[better]
            rows = np.unique(which)
            which = np.concatenate([which, np.repeat(rows, k)])
            ids, score = np.concatenate([ids, top_ids[rows].ravel()]), np.concatenate([score, tops[rows].ravel()])
            order = np.lexsort((ids, ~score, which))  # ~ turns the order around without overflow
            order = order[np.searchsorted(which[order], rows)[:, None] + np.arange(k)]
            tops[rows], top_ids[rows] = score[order], ids[order]
            last, last_id = tops[:, -1], top_ids[:, -1]
            higher = (last > bounds) | ((last == bounds) & (last_id < bound_ids))
            bounds, bound_ids = np.where(higher, last, bounds), np.where(higher, last_id, bound_ids)

        for begin in range(0, len(self.m), _TILE[1]):
            tile = slice(begin, begin + _TILE[1])
            size = len(self.m[tile])
            if (bound_ids == _LAST).any():
                # Some query has no bound yet: all pairs, but for scores below a query's k-th best here.
                if kind:
                    all_scores = q.astype(kind) @ self.m[tile].T.astype(kind)
                    all_scores[asked[:, None] == self.ids[tile]] = -np.inf
                    kth = np.partition(all_scores, -k, axis=1)[:, [-k]] if size > k else np.full((n, 1), -np.inf)
                    which, at = np.nonzero((all_scores >= kth) & (all_scores > -np.inf))
                    found.append((which, at + begin, all_scores[which, at].astype(np.int64)))
                else:
                    which, at = (x.ravel() for x in np.indices((n, size)))
                    found.append((which, at + begin))
                settle()
                continue
            if form is None:
                # Errors of single precision, by the number of terms.
                slack = (self.width + 8) * 2.0**-22
                needed = lambda: bounds[:, None] / (lengths * self.unit) - slack
                head, form = self.form(q, lengths, needed(), kind)
                columns = [*self.turned(q, lengths, head)] if head else [q]
                asks = np.hstack([*columns, np.zeros((n, 1))], dtype=form.dtype, casting="unsafe")
                lowest, raised = -int(lengths.max() * self.longest) - 2, True
            if not head:
                # Ids ascend: if none here is smaller than the bound's, an equal score is not enough.
                least = np.maximum(bounds + (bound_ids <= self.ids[begin]), lowest)
                asks[:, -1] = -least
            elif raised:
                asks[:, -1:], raised = -np.clip(needed(), -2, 2), False
            if out is None or out.shape[1] != size:
                out, mask = np.empty((n, size), form.dtype), np.empty((n, size), bool)
            np.matmul(asks, form[tile].T, out=out)
            np.greater_equal(out, 0, out=mask)
            some = _set(mask.ravel())
            if not len(some):
                continue
            which, at = np.divmod(some, size)
            score = () if head else (out[which, at].astype(np.int64) + least[which],)
            found.append((which, at + begin, *score))
            n_found += len(some)
            if n_found > k * n:
                settle()
                n_found, raised = 0, True
        if found:
            settle()
        which, at = np.nonzero(top_ids != _LAST)
        return asked[which], top_ids[which, at], tops[which, at]


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` vectors (vec_id, v) with the highest inner product for each of ``queries`` (vec_id, v).

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id. Vectors with the query's own
    id are left out, and rows without an id; of queries that share an id the smallest vector counts.
    """
    spark = vectors.sparkSession
    square = F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))
    vectors = vectors.where("vec_id IS NOT NULL").withColumn("norm", F.sqrt(square))
    vectors = saved(vectors, "products")
    count, width = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    schema = "query_id long, vec_id long, score long"
    if not count or not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    basis, slab_rows = rotation(vectors, width), _rows(_SLAB, width)

    def slab(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        # Parts differ in size by chance: twice the size is still one slab.
        for table in _tables(batches, 2 * slab_rows):
            table = table.sort_by("vec_id")
            columns = [[number], [table["norm"].to_numpy().max()], [table["vec_id"].to_numpy().tobytes()]]
            columns.append([_packed(_matrix(table["v"].combine_chunks(), width))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.float64(), pa.binary(), pa.binary()))],
                ["block", "longest", "ids", "m"],
            )

    # Partition 0 holds the longest vectors; ties of length are split by id.
    by_length = vectors.repartitionByRange(-(-count // slab_rows), F.col("norm").desc(), "vec_id")
    slabs = saved(by_length.mapInArrow(slab, "block int, longest double, ids binary, m binary"), "products-slabs")
    n_slabs = slabs.agg(F.max("block")).first()[0] + 1

    queries = queries.where("vec_id IS NOT NULL").select("vec_id", F.slice("v", 1, width).alias("v"))
    queries = saved(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "products-queries")
    n_groups = max(1, -(-queries.count() // _rows(_QUERIES, width)))

    def gather(table: pa.Table) -> pa.Table:
        columns = [table[c].to_numpy().astype(np.int64).tobytes() for c in ("vec_id", "bound", "bound_id")]
        columns.append(_packed(_matrix(table["v"].combine_chunks(), width)))
        return pa.table([pa.array([c], pa.binary()) for c in columns], ["q_ids", "bounds", "bound_ids", "q"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["query_id", "vec_id", "score"]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                ids, *asked = (np.frombuffer(row[c].as_buffer(), np.int64) for c in ("ids", "q_ids", "bounds", "bound_ids"))
                vectors = _Slab(ids, _unpacked(row["m"], len(ids), width), row["longest"].as_py(), basis, k)
                found = list(vectors.best(asked[0], _unpacked(row["q"], len(asked[0]), width), *asked[1:]))
                if found:
                    columns = [pa.array(np.concatenate(c)) for c in zip(*found)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    ranking = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")

    def found(asked: DataFrame, some: DataFrame) -> DataFrame:
        """The best of each slab; every slab meets every group of queries."""
        group = F.pmod(F.xxhash64("vec_id"), F.lit(n_groups))
        groups = asked.groupBy(group).applyInArrow(gather, "q_ids binary, bounds binary, bound_ids binary, q binary")
        pairs = some.hint("shuffle_replicate_nl").crossJoin(saved(groups, "products-groups"))
        return pairs.select("longest", "ids", "m", "q_ids", "bounds", "bound_ids", "q").mapInArrow(search, schema)

    def ranked(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("rank", F.row_number().over(ranking).cast("int"))
        return rows.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    ends = [n_slabs]
    while ends[0] >= _PASS:
        ends.insert(0, ends[0] // _PASS)
    unbounded = queries.withColumns({"bound": F.lit(int(_LEAST)), "bound_id": F.lit(int(_LAST))})
    best = ranked(found(unbounded, slabs.where(F.col("block") < ends[0])))
    for begin, end in itertools.pairwise(ends):
        best = saved(best, "products-best")
        last = best.where(F.col("rank") == k)
        bounds = last.select(F.col("query_id").alias("vec_id"), "score", F.col("vec_id").alias("id"))
        bound = F.coalesce("score", F.lit(int(_LEAST))).alias("bound")
        bound_id = F.coalesce("id", F.lit(int(_LAST))).alias("bound_id")
        bounded = queries.join(bounds, "vec_id", "left").select("vec_id", "v", bound, bound_id)
        rest = found(bounded, slabs.where((F.col("block") >= begin) & (F.col("block") < end)))
        best = ranked(rest.unionByName(best.drop("rank")))
    return best
