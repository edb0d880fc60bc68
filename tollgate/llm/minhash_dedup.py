"""Near-duplicate documents by fast similarity sketches, banding, and exact verification.

A sketch has ``t`` coordinates. In round ``i`` every shingle is hashed to one coordinate and to a value, and a
coordinate keeps the least (round, value): the first round that reaches a coordinate decides it. Rounds go on until
all coordinates are filled; the rounds from ``t`` on put every shingle into one given coordinate each, so sets of any
size fill all of them. A large set needs one or two rounds, that is a hash or two per shingle in place of ``t``, and
the share of coordinates that agree is as concentrated about the Jaccard similarity as for independent hashes.

``bands`` bands of ``rows`` coordinates are the cells. With 40 bands of 5, two sets at the threshold of 0.8 share no
cell in one of ten million pairs; that is the only loss, and higher similarities have less.

In each cell some members are pivots, 1 at first and 32 times as many in each further round. A pivot is compared
with all members of the cell that are not in its component and then leaves the cell; links join components between
the rounds. Pivots are taken outside the cell's largest component, and a cell is done when its members are of one
component. So a group of copies costs one comparison a member, and a few strangers among them one each. Comparisons
are made in blocks of pivots and members, by size and by the parity sketches of the sets, which bound the symmetric
difference from below; only pairs that pass leave a block, and these are confirmed on the full sets.

Equal sets are one node from the start. Node ids are 64-bit hashes that are checked against 128-bit ones; on a clash
the join starts anew with another seed. The full sets of nodes that share a cell are computed again from the texts,
which a bitmap of fixed size (1 MiB) selects; with very many of them it selects too many, which costs time only.

NULL texts and texts without words have an empty set and are linked with nothing; texts with fewer words than a
shingle are one shingle. Rows that repeat a ``doc_id`` are told apart by their sets, and NULL ids are never the least
of a component that has another. An empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from tollgate.llm.common import saved
from tollgate.llm.jaccard_join import components, differing, sketch

#: Bits of the map of documents whose sets are fetched.
_BITS = 1 << 23
#: Distinct sets that a task remembers, so as not to emit their cells again.
_SEEN = 200_000
#: Pivots and members (about) that a block compares.
_PIVOTS, _MEMBERS = 1024, 1024
#: Parts of a node's documents when they get their component.
_SALTS = 8

_STEP = np.uint64(0x9E3779B97F4A7C15)
_VALUE = np.uint64((1 << 48) - 1)
_EMPTY = np.uint64((1 << 64) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int, seed: int = 0) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles (uint64). Words are not remembered: vocabularies are large."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    reach = min(width, len(h))
    out = np.full(len(h) - reach + 1 if reach else 0, 1 + seed * 1_000 + reach, np.uint64)
    for i in range(reach):
        with np.errstate(over="ignore"):
            out = _mixed((out ^ h[i : i + len(out)]) * _STEP)
    return np.unique(out)


def similarity_sketch(s: np.ndarray, t: int) -> np.ndarray:
    """The fast similarity sketch of a set of hashes (uint64, not empty) with ``t`` coordinates."""
    out = np.full(t, _EMPTY)
    expected = math.ceil(t * (math.log(t) + 3) / len(s))  # rounds that fill all coordinates but in rare cases
    begin = 0
    while begin < t and (out == _EMPTY).any():
        rounds = np.arange(begin, min(t, begin + expected), dtype=np.uint64)[:, None]
        with np.errstate(over="ignore"):
            h = _mixed(s + (rounds + np.uint64(1)) * _STEP)
        place = ((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)
        # An earlier round is always less, so rounds may be worked off together.
        value = (rounds << np.uint64(48)) | (_mixed(h) & _VALUE)
        np.minimum.at(out, place.astype(np.int64).ravel(), value.ravel())
        begin += expected
    for coordinate in np.flatnonzero(out == _EMPTY).tolist():
        last = np.uint64(t + coordinate)
        with np.errstate(over="ignore"):
            out[coordinate] = (last << np.uint64(48)) | (_mixed(s + (last + np.uint64(1)) * _STEP) & _VALUE).min()
    return out


def band_keys(coordinates: np.ndarray, bands: int) -> np.ndarray:
    """One hash for each band of a sketch."""
    grid = coordinates.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for column in grid.T:
            key = _mixed((key ^ column) * _STEP)
    return key


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _node(full: bytes) -> int:
    return int.from_bytes(full[:8], "little", signed=True)


def _sketched(docs: DataFrame, width: int, bands: int, rows: int, seed: int) -> DataFrame:
    """Documents with n (size of the set), node, full (128-bit hash), k (parity sketch) and cells."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n", T.LongType()), T.StructField("node", T.LongType()),
            T.StructField("full", T.BinaryType()), T.StructField("k", T.BinaryType()), T.StructField("cells", T.ArrayType(T.LongType())),
        ]
    )
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for whole in batches:
            for begin in range(0, whole.num_rows, 1024):
                batch, out = whole.slice(begin, 1024), []
                for text in batch.column(1).to_pylist():
                    s = shingles(text, width, seed)
                    if not len(s):
                        out.append((0, None, None, None, None))
                        continue
                    full, k, cells = _digest(s), None, None
                    if full not in seen:
                        if len(seen) >= _SEEN:
                            seen.clear()
                        seen.add(full)
                        k = sketch(s).tobytes()
                        cells = band_keys(similarity_sketch(s, bands * rows), bands).view(np.int64)
                    out.append((len(s), _node(full), full, k, cells))
                columns = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    return saved(docs.select("doc_id", F.col("text").cast("string")).mapInArrow(describe, schema), "minhash-sets")


def _regions(sets: DataFrame) -> DataFrame:
    """Cells with several nodes, once for each set of members: cell, node."""
    entered = sets.where("cells IS NOT NULL").select(F.explode("cells").alias("cell"), "node")
    # Copies that several tasks have seen enter a cell more than once: least and greatest tell if it has another node.
    alike = entered.groupBy("cell").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("cell")
    several = saved(entered.join(alike, "cell").distinct(), "minhash-shared")
    same = several.groupBy("cell").agg(F.count("*").alias("m"), F.bit_xor("node").alias("x"), F.bit_xor(F.xxhash64("node")).alias("y"))
    chosen = same.groupBy("m", "x", "y").agg(F.min("cell").alias("cell")).select("cell")
    return several.join(chosen, "cell")


def _members(docs: DataFrame, sets: DataFrame, nodes: DataFrame, width: int, seed: int) -> DataFrame:
    """Full sets of ``nodes``: node, s. One document is read for each, and those that share its place in the bitmap."""
    wanted = saved(sets.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "minhash-wanted")
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(_BITS)).alias("slot")
    marked = wanted.select(slot).selectExpr("slot DIV 64 AS at", "shiftleft(1L, CAST(slot % 64 AS INT)) AS bit")
    bitmap = np.zeros(_BITS // 64, np.int64)
    for row in marked.groupBy("at").agg(F.bit_or("bit").alias("bits")).collect():  # _BITS / 64 rows at most
        bitmap[row["at"]] = row["bits"]
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value.view(np.uint8)
        for batch in batches:
            at = batch.column(1).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array((bits[at >> 3] >> (at & 7)) & 1 == 1))
            for begin in range(0, batch.num_rows, 512):
                found = [shingles(text, width, seed) for text in batch.column(0).slice(begin, 512).to_pylist()]
                found = [s for s in found if len(s)]
                node = pa.array([_node(_digest(s)) for s in found], pa.int64())
                yield pa.RecordBatch.from_arrays([node, pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], ["node", "s"])

    fetched = docs.select(F.col("text").cast("string"), slot).mapInArrow(fetch, "node long, s array<long>")
    return saved(fetched.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "minhash-members")


def _labelled(df: DataFrame, labels: DataFrame | None, node: str, name: str) -> DataFrame:
    """Add the component that a node is known to be in."""
    if labels is None:
        return df.withColumn(name, F.col(node))
    of = labels.select(F.col("u").alias(node), F.col("v").alias("_v"))
    return df.join(of, node, "left").withColumn(name, F.coalesce("_v", node)).drop("_v")


def _stacked(sketches: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Sketches by their length: their numbers and a row each."""
    length = np.fromiter(map(len, sketches), np.int64, len(sketches))
    found = {}
    for size in np.unique(length).tolist():
        numbers = np.flatnonzero(length == size)
        found[size] = numbers, np.frombuffer(b"".join([sketches[i] for i in numbers]), np.uint64).reshape(len(numbers), -1)
    return found


def _folded(rows: np.ndarray, width: int) -> np.ndarray:
    while rows.shape[1] > width:  # a sketch of half the places is the sum of its halves
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


def differences(pivots: list[bytes], members: list[bytes]) -> np.ndarray:
    """Places in which the sketches of pivots (rows) and members (columns) differ."""
    out = np.zeros((len(pivots), len(members)), np.int64)
    if out.size <= 8:
        for i, a in enumerate(pivots):
            out[i] = [differing(a, b) for b in members]
        return out
    groups = _stacked(members).values()
    for numbers, rows in _stacked(pivots).values():
        for others, columns in groups:
            width = min(rows.shape[1], columns.shape[1])
            a, b = _folded(rows, width), _folded(columns, width)
            for number, row in zip(numbers, a):
                out[number, others] = np.bitwise_count(b ^ row).sum(axis=1)
    return out


def _compared(blocks: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each block's pivots and members that can be linked.

    ``blocks`` has cell, block and chunk, which name a block, kind (0 for pivots, 1 for members), turn (place among
    the cell's pivots of this round, 0 for others), node, label, n and k.
    """
    name = ["cell", "block", "chunk"]

    def within(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        kind, turn, node, label, n = (rows.column(i).to_numpy(zero_copy_only=False) for i in range(3, 8))
        k, p = rows.column(8).to_pylist(), int((kind == 0).sum())
        possible = label[:p, None] != label[p:]
        # Of two pivots the earlier one does it.
        possible &= (turn[p:] == 0) | (turn[p:] > turn[:p, None])
        possible &= 100 * np.minimum(n[:p, None], n[p:]) >= percent * np.maximum(n[:p, None], n[p:])
        if not possible.any():
            return node[:0], node[:0]
        x = differences(k[:p], k[p:])
        # Linked sets differ in at most (1 - t) / (1 + t) of both sizes.
        i, j = np.nonzero(possible & (x * (100 + percent) <= (n[:p, None] + n[p:]) * (100 - percent)))
        return node[:p][i], node[p:][j]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last block, which may go on

        def done(rows: pa.RecordBatch, ends: list[int]) -> pa.RecordBatch:
            found = [within(rows.slice(begin, end - begin)) for begin, end in zip([0, *ends], ends)]
            a, b = (np.concatenate(side) for side in zip(*found))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        for batch in batches:
            rows = pa.concat_batches([*held, batch])
            keys = [rows.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            new = reduce(np.logical_or, [key[1:] != key[:-1] for key in keys])
            ends = (np.flatnonzero(new) + 1).tolist()
            if ends:
                yield done(rows, ends)
            held = [rows.slice(ends[-1] if ends else 0)]
        if held and held[0].num_rows:
            yield done(held[0], [held[0].num_rows])

    ordered = blocks.repartition(*name).sortWithinPartitions(*name, "kind")
    return ordered.select(*name, "kind", "turn", "node", "label", "n", "k").mapInArrow(compare, "a long, b long").distinct()


def _blocks(current: DataFrame, pivots: DataFrame, sketches: DataFrame, many: int) -> DataFrame:
    """Members of open cells, cut into chunks, and for each chunk the cell's pivots, cut into blocks."""
    chunks = F.expr(f"size DIV {_MEMBERS} + 1")
    blocks = F.expr(f"CAST((least({many}, size - major_n) + {_PIVOTS - 1}) DIV {_PIVOTS} AS INT)")
    turns = pivots.select("cell", "node", "turn")
    members = current.join(turns, ["cell", "node"], "left").withColumns({"turn": F.coalesce("turn", F.lit(0)), "kind": F.lit(1)})
    members = members.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks)).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    firsts = pivots.withColumns({"kind": F.lit(0), "block": F.expr(f"CAST((turn - 1) DIV {_PIVOTS} AS INT)")})
    firsts = firsts.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    columns = ["cell", "block", "chunk", "kind", "turn", "node", "label"]
    return members.select(*columns).unionByName(firsts.select(*columns)).join(sketches, "node")


def _linked(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    left, right = members.selectExpr("node AS a", "s AS x"), members.selectExpr("node AS b", "s AS y")
    sizes = pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size(F.array_intersect("x", "y")).alias("common"), (F.size("x") + F.size("y")).alias("total")
    )
    return sizes.where(f"100 * common >= {percent} * (total - common)").select("a", "b")


def _with_components(sets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """doc_id, n_shingles and component_id; only nodes with copies or links need to be looked up."""
    firsts = sets.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    firsts = _labelled(firsts, labels, "node", "root")
    found = firsts.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("copies").alias("size")).where("size > 1")
    known = firsts.select("node", "root").join(found.select("root", "component_id"), "root").select("node", "component_id")
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    salted = sets.select("doc_id", "n", "node", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)).cast("int").alias("salt"))
    joined = salted.join(known, ["node", "salt"], "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, width: int = 4, percent: int = 80, bands: int = 40, rows: int = 5) -> DataFrame:
    """Components of documents (doc_id, text) with a similarity of ``percent`` or more.

    Returns doc_id, n_shingles, component_id (least doc_id of the component).
    """
    seed = 0
    while True:
        sets = _sketched(docs, width, bands, rows, seed)
        clash = sets.where("node IS NOT NULL").groupBy("node").agg(F.min("full").alias("a"), F.max("full").alias("b"))
        if clash.where("a <> b").isEmpty():
            break
        seed += 1
    regions = saved(_regions(sets), "minhash-regions")
    nodes = regions.select("node").distinct()
    members = _members(docs, sets, nodes, width, seed)
    sketches = sets.where("k IS NOT NULL").join(nodes, "node", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("k").alias("k"))
    sketches = saved(sketches, "minhash-sketches")
    labels, many = None, 1
    while True:
        current = _labelled(regions, labels, "node", "label")
        held = current.groupBy("cell", "label").agg(F.count("*").alias("m"))
        major = F.max(F.struct("m", "label")).alias("major")
        open_ = held.groupBy("cell").agg(F.sum("m").alias("size"), major, F.count("*").alias("parts")).where("parts > 1")
        open_ = open_.selectExpr("cell", "size", "major.m AS major_n", "major.label AS major")
        current = saved(current.join(open_, "cell"), "minhash-open")
        if current.isEmpty():
            return _with_components(sets, labels)
        turn = F.row_number().over(Window.partitionBy("cell").orderBy("node"))
        pivots = saved(current.where("label <> major").withColumn("turn", turn).where(F.col("turn") <= many), "minhash-pivots")
        possible = saved(_compared(_blocks(current, pivots, sketches, many), percent), "minhash-possible")
        found = saved(_linked(possible, members, percent), "minhash-links")
        if not found.isEmpty():
            edges = found.selectExpr("a AS u", "b AS v")
            labels = components(edges if labels is None else edges.unionByName(labels))
        left = current.select("cell", "node").join(pivots.select("cell", "node"), ["cell", "node"], "left_anti")
        regions = saved(left, "minhash-regions")  # read twice in the next round
        many *= 32
