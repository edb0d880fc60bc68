"""Near-duplicate documents by a metric-space join under the Jaccard distance of their shingle sets.

Nearly all documents are at distance 1 of any one document, so regions around sampled documents would each
receive everything. The outermost pivots are therefore the shingles: a document lies in the cells of its foremost
shingles in a global order, that of their hashes. Two sets with a similarity of ``t`` have at least ``t |x|``
shingles in common, so their first common one is among the first ``|x| - ceil(t |x|) + 1`` of both: that is the
window by which documents are replicated. It is made a twentieth of the set longer; then near documents meet in
more than that many cells, and all that share a few lines or a passage drop out before they are compared.

Within a cell the metric is the number of places in which parity sketches differ, in which common shingles cancel
out. It is at most the symmetric difference of the sets, which for linked ones is at most ``(1 - t) / (1 + t)`` of both
sizes: their reach. The least member of a cell is its first pivot, and linked members make one component with it.
Then in each round 32 times as many pivots, outside the cell's largest component, are compared with the members and
leave the cell, until its members are of one component or its pivots are used up. A cell of copies so costs a
comparison per member, not one per pair. Of cells with few members all pairs are listed at once. Listed pairs, and those
with first pivots, are made distinct over all cells before sketches are joined to them.

Pivots and members are compared in blocks, and large blocks by recursion: some pivots are centres, each pivot is of
the Voronoi region of its nearest centre, and a member enters the regions that the triangle inequality leaves open:
those no further than its nearest centre by twice its reach, and whose distances from the centre it is within reach of.
Regions are split again until they are small, or until a split no longer halves the comparisons. A pair that is first
together in a cell has no earlier shingle in common, so its two places there add up to at most its reach; in other
cells it need not be compared. Members without a possible partner leave a cell at the start, and members of blocks bring
their earlier large cells, so that a pair leaves the blocks of one cell only. What is left of a block are the pairs whose sketches are within reach: these are
intersected in full, first one pair for each node, and then those that this has not connected. The sets lie in a table
bucketed by node, so that no round shuffles them again.

Equal sets are one node. Node ids are 64-bit hashes, checked against 128-bit ones; on a clash the join starts
anew with another seed.

NULL texts and texts without words have an empty set and are linked with nothing; texts with fewer words
than a shingle are one shingle. Rows that repeat a ``doc_id`` are told apart by their sets. An empty table gives
no rows; other columns are dropped.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.llm.common import drop, saved

#: A window is longer than the least by one in so many of a set's shingles.
_EXTRA = 20
#: Bits of the map of documents whose sets are fetched. At more documents it lets more through, but loses none.
_BITS = 1 << 23
#: Members up to which all pairs of a cell are looked at.
_FEW = 32
#: Places of the shortest sketches. The more, the fewer pairs just under the threshold are within reach.
_LEAST = 1024
#: Distinct sets that a task remembers, so as not to emit their cells again.
_SEEN = 200_000
#: Pivots and members (about) that a block compares.
_BLOCK = 2048
#: Centres of a split, and comparisons below which a region is not split.
_CENTRES, _SMALL = 16, 1 << 14
#: Pairs of small blocks that are compared together.
_TOGETHER = 1 << 16
#: Parts of a node's documents when they get their component.
_SALTS = 8

#: Words whose hashes a worker keeps beside the caches of other operators; hashing one again is cheap.
_WORDS = 1 << 17
_hashes: dict[bytes, int] = {}


def shingles(text: str | None, width: int, seed: int = 0) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles (uint64)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if len(_hashes) > _WORDS:
        _hashes.clear()
    h = np.fromiter(map(_hashes.get, words, repeat(0)), np.uint64, len(words))
    for i in np.flatnonzero(h == 0).tolist():
        h[i] = _hashes[words[i]] = xxhash.xxh3_64_intdigest(words[i]) | 1
    if not len(h):
        return h
    n, reach = max(1, len(h) - width + 1), min(width, len(h))
    with np.errstate(over="ignore"):
        mixed = np.full(n, 0x9E3779B97F4A7C15 + seed + reach, np.uint64)
        for i in range(reach):
            mixed = (mixed ^ h[i : i + n]) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _extra(n: int) -> int:
    """Common shingles beyond the first that a document of ``n`` shingles extends its window for."""
    return n // _EXTRA


def _sets(docs: DataFrame, width: int, percent: int, seed: int) -> DataFrame:
    """Documents with n (size of the set), node, full (128-bit hash) and cells (shingles whose cells they enter)."""
    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("node", T.LongType()), T.StructField("full", T.BinaryType()), T.StructField("cells", T.ArrayType(T.LongType()))]
    )

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()
        for batch in batches:
            for begin in range(0, len(batch), 512):
                part, rows = batch.iloc[begin : begin + 512], []
                for doc, text in zip(part["doc_id"], part["text"]):
                    s = shingles(text, width, seed)
                    n = len(s)
                    if not n:
                        rows.append((doc, 0, None, None, None))
                        continue
                    full = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    cells = None
                    if full not in seen:
                        if len(seen) >= _SEEN:
                            seen.clear()
                        seen.add(full)
                        # Hashes ascend, which is the global order; it is kept when they are signed.
                        cells = (s[: n - -(-percent * n // 100) + 1 + _extra(n)] ^ np.uint64(1 << 63)).view(np.int64)
                    rows.append((doc, n, int.from_bytes(full[:8], "little", signed=True), full, cells))
                yield pd.DataFrame(rows, columns=schema.names)

    return saved(docs.select("doc_id", "text").mapInPandas(describe, schema), "near-sets")


def _cells(sets: DataFrame, percent: int) -> DataFrame:
    """Cells with more than one node, once for each set of members: cell, node, place (in the window), n, m (members at most).

    Left out are members that can be first together with no other there: those that have too few cells in company from
    there on to be near any other, or a place that is too far for all others.
    """
    entered = sets.where("cells IS NOT NULL").select(F.posexplode("cells").alias("place", "cell"), "node")
    members = entered.repartition("cell").groupBy("cell", "node").agg(F.first("place").alias("place"))
    together = Window.partitionBy("cell")
    several = members.withColumns({"m": F.count("*").over(together), "least": F.min("place").over(together)}).where("m > 1")
    shared = saved(several.select("cell", "node", "place", "least"), "near-shared")
    # A partner has at least this part of the shingles, so both windows hold as many common ones as its extra. The first
    # of them has the others at later places, and a place too far for any other of the cell is not the first.
    tail = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("place")))
    sizes = sets.where("cells IS NOT NULL").select("node", "n").distinct()
    first = f"tail >= 1 + ceil({percent} * n / 100) div {_EXTRA} AND (place + least) * {percent} <= n * {100 - percent}"
    several = saved(shared.withColumn("tail", tail).join(sizes, "node").where(first).select("cell", "node", "place", "n"), "near-cells")
    drop(shared)
    same = several.groupBy("cell").agg(
        F.count("*").alias("m"), F.bit_xor("node").alias("x"), F.bit_xor(F.xxhash64("node")).alias("y"), F.min("place").alias("least"), F.max("n").alias("most")
    )
    # The least of such cells, as a pair's first cell must stay.
    chosen = same.where("m > 1").groupBy("m", "x", "y").agg(F.min(F.struct("cell", "least", "most")).alias("c")).select("c.*", "m")
    largest = f"least(most, n * 100 DIV {percent})"
    near = several.join(chosen, "cell").where(f"(place + least) * {100 + percent} <= (n + {largest}) * {100 - percent}")
    regions = saved(near.select("cell", "node", "place", "n", "m"), "near-regions")
    drop(several)
    return regions


def _first_pairs(regions: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of small cells, and of the least members of large ones with the others: a, b. And the others: cell, node, place, n.

    Each pair is one row and can be linked and first together in a cell.
    """
    one = F.struct("node", "place", "n")
    listed = regions.where(f"m <= {_FEW}").groupBy("cell").agg(F.sort_array(F.collect_list(one)).alias("all"))
    ones = listed.select("all", F.posexplode("all").alias("i", "a"))
    pairs = ones.select("a", F.explode(F.expr("slice(all, i + 2, size(all))")).alias("b"))
    large = regions.where(f"m > {_FEW}")
    others = saved(large.join(large.groupBy("cell").agg(F.min(one).alias("a")), "cell").where("node <> a.node"), "near-others")
    pairs = pairs.unionByName(others.select("a", one.alias("b")))
    alike = f"100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)"
    first = f"(a.place + b.place) * {100 + percent} <= (a.n + b.n) * {100 - percent}"
    pairs = pairs.where(f"{alike} AND {first}").selectExpr("a.node AS a", "b.node AS b").distinct()
    return saved(pairs, "near-first"), others.select("cell", "node", "place", "n")


def sketch(s: np.ndarray, least: int = 64) -> np.ndarray:
    """Parity of the shingles in each of about four times as many places, ``least`` at least, packed into bytes."""
    bits = max(least, 1 << (4 * len(s)).bit_length())
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1, bitorder="little")


def differing(a: bytes, b: bytes) -> int:
    """Places in which two sketches differ: at most the number of shingles that only one set has."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) != len(y):  # a sketch of half the places is the sum of its halves
        if len(x) > len(y):
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        else:
            y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _short(s: np.ndarray) -> bytes:
    """A set's sketch folded once, as cells hold one for each of their members, but not below ``_LEAST`` places."""
    words = sketch(s, _LEAST).view(np.uint64)[None]
    return _folded(words, max(_LEAST // 64, words.shape[1] // 2)).tobytes()


def _members(docs: DataFrame, sets: DataFrame, nodes: DataFrame, width: int, seed: int, table: str) -> DataFrame:
    """Sets of ``nodes`` as a bucketed table: node, n, k (sketch), s, and their cells. A document is read for each."""
    wanted = sets.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"))
    wanted = saved(wanted, "near-wanted")
    slots = wanted.select(F.pmod(F.xxhash64("doc_id"), F.lit(_BITS)).alias("slot")).selectExpr("slot DIV 64 AS at", "shiftleft(1L, CAST(slot % 64 AS INT)) AS bit")
    found = slots.groupBy("at").agg(F.bit_or("bit").alias("b")).collect()  # _BITS / 64 rows at most
    bitmap = np.zeros(_BITS // 64, np.int64)
    bitmap[[r["at"] for r in found]] = [r["b"] for r in found]
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marked = shared.value.view(np.uint8)
        for batch in batches:
            slot = batch["slot"].to_numpy()
            batch = batch[(marked[slot >> 3] >> (slot & 7)) & 1 == 1]
            for begin in range(0, len(batch), 512):
                found = [shingles(t, width, seed) for t in batch["text"].iloc[begin : begin + 512]]
                found = [s for s in found if len(s)]
                node = [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=16).digest()[:8], "little", signed=True) for s in found]
                yield pd.DataFrame(
                    {
                        "node": np.array(node, np.int64), "n": np.array([len(s) for s in found], np.int64),
                        "k": [_short(s) for s in found], "s": [s.view(np.int64) for s in found],
                    }
                )

    slotted = docs.select("text", F.pmod(F.xxhash64("doc_id"), F.lit(_BITS)).alias("slot"))
    spark = docs.sparkSession
    fetched = slotted.mapInPandas(fetch, "node long, n long, k binary, s array<long>")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fetched = fetched.repartition(parts, "node").dropDuplicates(["node"]).join(nodes, "node")
    fetched.write.bucketBy(parts, "node").sortBy("node").format("parquet").saveAsTable(table)
    return spark.table(table)


def _same(a: DataFrame, b: DataFrame) -> bool:
    total = [F.count("*"), F.bit_xor(F.xxhash64("u", "v"))]
    return a.agg(*total).first() == b.agg(*total).first()


def components(edges: DataFrame) -> DataFrame:
    """Least node of each connected component of ``edges`` (u, v): u, v, with v the least, for all but it.

    Alternates the two star operations until every component is a star.
    """
    edges = saved(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "near-edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = saved(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "near-edges")
        if _same(edges, small):
            return small
        edges = small


def _labelled(df: DataFrame, labels: DataFrame | None, node: str, name: str) -> DataFrame:
    """Add the component that a node is known to be in."""
    if labels is None:
        return df.withColumn(name, F.col(node))
    return df.join(labels.selectExpr(f"u AS {node}", "v AS _v"), node, "left").withColumn(name, F.coalesce("_v", node)).drop("_v")


def _folded(rows: np.ndarray, width: int) -> np.ndarray:
    while rows.shape[1] > width:  # a sketch of half the places is the sum of its halves
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places in which the rows of ``a`` differ from each row of ``b``."""
    out = np.empty((len(a), len(b)), np.int32)
    for i, row in enumerate(a):
        out[i] = np.bitwise_count(b ^ row).sum(axis=1)
    return out


def voronoi_pairs(a: np.ndarray, a_n: np.ndarray, b: np.ndarray, b_n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows i of ``a`` and j of ``b``, sketches of sets of the given sizes, that are within reach, and their distance."""
    found, open_ = [], [(np.arange(len(a)), np.arange(len(b)))]
    while open_:
        i, j = open_.pop()
        regions = []
        if len(i) * len(j) > _SMALL and len(i) > 2 * _CENTRES:
            centres = a[i[:: len(i) // _CENTRES][:_CENTRES]]
            inner, outer = _distances(centres, a[i]), _distances(centres, b[j])
            region = inner.argmin(axis=0)
            reach = b_n[j] * (100 - percent) / percent  # of the largest set that could be linked
            near = outer <= outer.min(axis=0) + 2 * reach
            for c in range(len(centres)):
                own = region == c
                if own.any():
                    d = inner[c, own]
                    entered = near[c] & (outer[c] <= d.max() + reach) & (outer[c] >= d.min() - reach)
                    regions.append((i[own], j[entered]))
            if 2 * sum(len(x) * len(y) for x, y in regions) <= len(i) * len(j):
                open_ += [(x, y) for x, y in regions if len(y)]
                continue
        x = _distances(a[i], b[j])
        p, q = np.nonzero(x * (100 + percent) <= (a_n[i][:, None] + b_n[j]) * (100 - percent))
        found.append((i[p], j[q], x[p, q]))
    if not found:
        return np.arange(0), np.arange(0), np.arange(0)
    return tuple(np.concatenate(column) for column in zip(*found))


class _Sketches:
    """Sketches of a column as arrays."""

    def __init__(self, k: pa.Array):
        ends = np.frombuffer(k.buffers()[1], np.int32)[k.offset : k.offset + len(k) + 1].astype(np.int64)
        self.words = np.frombuffer(k.buffers()[2], np.uint64, int(ends[-1]) // 8)
        self.begin, self.size = ends[:-1] // 8, np.diff(ends) // 8

    def of(self, rows: np.ndarray, size: int) -> np.ndarray:
        """Sketches of rows that have ``size`` words each."""
        return self.words[self.begin[rows][:, None] + np.arange(size)]

    def apart(self, a: np.ndarray, other: _Sketches, b: np.ndarray) -> np.ndarray:
        """Places in which each of ``a`` differs from its partner in ``b``, rows of another column."""
        x = np.zeros(len(a), np.int64)
        sizes = self.size[a] * (1 << 32) + other.size[b]
        for both in np.unique(sizes).tolist():
            at, (p, q) = np.flatnonzero(sizes == both), divmod(both, 1 << 32)
            for begin in range(0, len(at), 4096):
                part = at[begin : begin + 4096]
                left, right = self.of(a[part], p), other.of(b[part], q)
                x[part] = np.bitwise_count(_folded(left, min(p, q)) ^ _folded(right, min(p, q))).sum(axis=1)
        return x


class _Rows:
    """Rows of blocks as arrays: whether they are brought as pivots, are pivots, and what is known of them."""

    def __init__(self, rows: pa.RecordBatch, percent: int):
        self.percent = percent
        self.kind, self.pivot, self.node, self.label, self.n, self.place = (rows.column(c).to_numpy(zero_copy_only=False) for c in range(3, 9))
        self.sketches = _Sketches(rows.column(9))
        ends = rows.column(10).offsets.to_numpy().astype(np.int64)
        self.before, self.earlier = ends[:-1], np.diff(ends)
        self.cells, cells = np.unique(rows.column(10).values.to_numpy(), return_inverse=True)
        # Each row's earlier cells; as they ascend within a row, so do these numbers.
        owner = np.repeat(np.arange(len(self.earlier)), self.earlier)
        self.held = owner * len(self.cells) + cells[ends[0] : ends[-1]]
        self.before = self.before - ends[0]

    def first(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs are in no earlier cell together."""
        swap = self.earlier[a] > self.earlier[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        good = np.ones(len(a), bool)
        for begin in range(0, len(a), 1 << 15):
            p, q = a[begin : begin + (1 << 15)], b[begin : begin + (1 << 15)]
            length = self.earlier[p]
            pair = np.repeat(np.arange(len(p)), length)
            if not len(pair):
                continue
            at = np.arange(len(pair)) - np.repeat(np.cumsum(length) - length, length) + self.before[p][pair]
            wanted = self.held[at] + (q - p)[pair] * len(self.cells)
            place = np.minimum(np.searchsorted(self.held, wanted), len(self.held) - 1)
            good[begin + pair[self.held[place] == wanted]] = False
        return good

    def worth(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of a pivot and a member are to be compared here."""
        p, least, most = self.percent, np.minimum(self.n[a], self.n[b]), np.maximum(self.n[a], self.n[b])
        good = (self.label[a] != self.label[b]) & (100 * least >= p * most)
        good &= (self.place[a] + self.place[b]) * (100 + p) <= (least + most) * (100 - p)
        # Of two pivots one does it.
        return good & ((self.pivot[b] == 0) | (self.node[a] < self.node[b]))

    def few(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs within reach of given ones."""
        good = self.worth(a, b)
        a, b = a[good], b[good]
        x = self.sketches.apart(a, self.sketches, b)
        good = x * (100 + self.percent) <= (self.n[a] + self.n[b]) * (100 - self.percent)
        return a[good], b[good], x[good]

    def many(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs within reach of all pivots ``a`` and members ``b``."""
        size = self.sketches.size
        for p in np.unique(size[a]).tolist():
            for q in np.unique(size[b]).tolist():
                # Sketches of linked sets differ in length by less than this, as those lengths are powers of two.
                if max(p, q) * self.percent > 200 * min(p, q):
                    continue
                i, j = a[size[a] == p], b[size[b] == q]
                left, right = _folded(self.sketches.of(i, p), min(p, q)), _folded(self.sketches.of(j, q), min(p, q))
                x, y, d = voronoi_pairs(left, self.n[i], right, self.n[j], self.percent)
                good = self.worth(i[x], j[y])
                yield i[x][good], j[y][good], d[good]

    def pairs(self, ends: list[int]) -> pa.RecordBatch:
        """Pairs within reach of all blocks: a, b, x."""
        found, left, right, held = [], [], [], 0
        for begin, end in zip([0, *ends], ends):
            p = int((self.kind[begin:end] == 0).sum())
            i, j = np.arange(begin, begin + p), np.arange(begin + p, end)
            if len(i) * len(j) > 256:
                found += self.many(i, j)
                continue
            left.append(np.repeat(i, len(j)))
            right.append(np.tile(j, len(i)))
            held += len(i) * len(j)
            if held > _TOGETHER:
                found.append(self.few(np.concatenate(left), np.concatenate(right)))
                left, right, held = [], [], 0
        if left:
            found.append(self.few(np.concatenate(left), np.concatenate(right)))
        a, b, x = (np.concatenate(column) for column in zip(*found)) if found else (np.arange(0),) * 3
        good = self.first(a, b)
        a, b, x = self.node[a[good]], self.node[b[good]], x[good]
        columns = [np.minimum(a, b), np.maximum(a, b), x.astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "x"])


def _within_reach(current: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs of pivots and members of a cell that are within reach and in no earlier cell: a, b, x (distance).

    ``current`` has cell, node, place, n, label, pivot, size and firsts (about how many members and pivots the cell has).
    """
    name = ["cell", "block", "chunk"]
    chunks, blocks = F.expr(f"size DIV {_BLOCK} + 1"), F.expr(f"firsts DIV {_BLOCK} + 1")
    hashed = current.withColumns({"chunks": chunks, "blocks": blocks, "h": F.xxhash64("node")})
    first = F.lit(0).cast("long")
    rows = hashed.withColumns({"kind": F.lit(1), "chunk": F.expr("pmod(h, chunks)"), "block": F.explode(F.sequence(first, F.col("blocks") - 1))})
    firsts = hashed.where("pivot = 1").withColumns({"kind": F.lit(0), "block": F.expr("pmod(h, blocks)"), "chunk": F.explode(F.sequence(first, F.col("chunks") - 1))})
    columns = [*name, "kind", "pivot", "node", "label", "n", "place"]
    rows = rows.select(*columns).unionByName(firsts.select(*columns)).join(members.select("node", "k", "cells"), "node")
    rows = rows.withColumn("cells", F.expr("filter(cells, c -> c < cell)"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last block, which may go on
        for batch in batches:
            rows = pa.concat_batches([*held, batch])
            new = np.zeros(max(0, rows.num_rows - 1), bool)
            for c in range(3):
                key = rows.column(c).to_numpy(zero_copy_only=False)
                new |= key[1:] != key[:-1]
            ends = (np.flatnonzero(new) + 1).tolist()
            if ends:
                yield _Rows(rows, percent).pairs(ends)
            held = [rows.slice(ends[-1] if ends else 0)]
        if held and held[0].num_rows:
            yield _Rows(held[0], percent).pairs([held[0].num_rows])

    ordered = rows.repartition(*name).sortWithinPartitions(*name, "kind").select(*columns, "k", "cells")
    return ordered.mapInArrow(compare, "a long, b long, x long")


def _near(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs that are within reach: a, b, x (distance)."""
    left, right = members.selectExpr("node AS a", "n AS p", "k"), members.selectExpr("node AS b", "n AS q", "k AS l")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            every = np.arange(rows.num_rows)
            x = _Sketches(rows.column(4)).apart(every, _Sketches(rows.column(5)), every)
            n = rows.column(2).to_numpy() + rows.column(3).to_numpy()
            good = pa.array(x * (100 + percent) <= n * (100 - percent))
            yield pa.RecordBatch.from_arrays([c.filter(good) for c in (rows.column(0), rows.column(1), pa.array(x))], ["a", "b", "x"])

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "p", "q", "k", "l")
    return both.mapInArrow(compare, "a long, b long, x long")


def _intersected(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs that are linked."""
    left, right = members.selectExpr("node AS a", "s AS x"), members.selectExpr("node AS b", "s AS y")
    sizes = pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size(F.array_intersect("x", "y")).alias("common"), (F.size("x") + F.size("y")).alias("total")
    )
    return sizes.where(f"100 * common >= {percent} * (total - common)").select("a", "b")


def _with_components(sets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """doc_id, n_shingles and component_id of all documents. Only nodes with copies or links are looked up, in parts."""
    firsts = sets.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    firsts = _labelled(firsts, labels, "node", "root")
    shared = firsts.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("copies").alias("size")).where("size > 1")
    known = firsts.join(shared.select("root", "component_id"), "root").select("node", "component_id")
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))))
    rows = sets.select("doc_id", F.col("n").alias("n_shingles"), "node", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)).alias("salt"))
    joined = rows.join(known, ["node", "salt"], "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _linked(alive: DataFrame, labels: DataFrame | None, members: DataFrame, percent: int) -> DataFrame | None:
    """Components (u, v) once the pairs within reach are compared, nearest ones first, then those not connected by them."""
    nearest = F.row_number().over(Window.partitionBy("b").orderBy("x", "a"))
    alive = saved(alive.withColumn("turn", F.when(nearest == 1, 1).otherwise(2)), "near-turns")
    for turn in (1, 2):
        asked = alive.where(F.col("turn") == turn)
        if turn > 1:
            asked = _labelled(_labelled(asked, labels, "a", "a_label"), labels, "b", "b_label")
            asked = asked.where("a_label <> b_label")
        found = saved(_intersected(asked.select("a", "b"), members, percent), "near-links")
        if not found.isEmpty():
            edges = found.selectExpr("a AS u", "b AS v")
            labels = components(edges if labels is None else edges.unionByName(labels))
        drop(found)
    drop(alive)
    return labels


def _joined(pairs: DataFrame, regions: DataFrame, members: DataFrame, percent: int) -> DataFrame | None:
    """Components (u, v) of the nodes of given pairs and of all cells; None if nothing is linked."""
    labels = _linked(_near(pairs, members, percent), None, members, percent)
    many, last = 32, None
    while True:
        # Cells of one component are done, and those whose pivots are used up.
        current = _labelled(regions, labels, "node", "label")
        parts = current.groupBy("cell", "label").agg(F.count("*").alias("m"))
        open_ = parts.groupBy("cell").agg(F.sum("m").alias("size"), F.max(F.struct("m", "label")).alias("major"), F.count("*").alias("parts"))
        open_ = open_.where("parts > 1").selectExpr("cell", "size", "major.label AS major", "size - major.m AS others")
        # Nodes are hashes, so about so many are below; the same ones in all cells.
        share = f"(CAST(node AS DOUBLE) + 9223372036854775808D) / 18446744073709551616D < {many}D / others"
        pivot, firsts = F.expr(f"label <> major AND (others <= {many} OR {share})"), F.expr(f"least(others, {many}L)")
        current = current.join(open_, "cell").withColumns({"pivot": pivot.cast("int"), "firsts": firsts})
        current = saved(current.drop("major", "others"), "near-open")
        if last is not None:
            drop(last)  # all that the cells are now is in the table of open ones
        last = current
        if current.isEmpty():
            return labels
        labels = _linked(_within_reach(current, members, percent), labels, members, percent)
        regions = current.where("pivot = 0").select("cell", "node", "place", "n")
        many *= 32


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """Components of documents (doc_id, text) with a similarity of ``percent`` or more.

    Returns doc_id, n_shingles, component_id (least doc_id of the component).
    """
    seed = 0
    while True:
        sets = _sets(docs, width, percent, seed)
        clash = sets.where("node IS NOT NULL").groupBy("node").agg(F.min("full").alias("a"), F.max("full").alias("b"))
        if clash.where("a <> b").isEmpty():
            break
        seed += 1
    regions = _cells(sets, percent)
    table = f"near_members_{uuid.uuid4().hex}"
    try:
        pairs, others = _first_pairs(regions, percent)
        cells = regions.where(f"m > {_FEW}").groupBy("node").agg(F.sort_array(F.collect_list("cell")).alias("cells"))
        paired = pairs.selectExpr("explode(array(a, b)) AS node").distinct()
        nodes = saved(paired.join(cells, "node", "full"), "near-nodes")
        members = _members(docs, sets, nodes, width, seed, table)
        labels = _joined(pairs, others, members, percent)
    finally:
        docs.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    return _with_components(sets, labels)
