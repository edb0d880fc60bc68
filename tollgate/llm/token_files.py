"""Token ids in flat binary files with 64-bit document offsets.

A dataset is a folder with three files per partition, partitions and documents in ascending ``doc_id``:

- ``part-<n>.ids``: unsigned little-endian integers, 2 bytes each if the vocabulary allows, else 4;
- ``part-<n>.offsets``: signed 64-bit integers, where each document begins in the file, and the end;
- ``part-<n>.docs``: an Arrow file of the document ids;

and ``manifest.json``: the width of an id and, per partition, documents, tokens and the number of tokens
before it, which is the prefix sum of the partitions' counts. ``open_part`` maps a partition into memory
where the folder is a path of this machine. Files are written under a name of the attempt and then
renamed, so a task that is run again replaces what it wrote.

NULL texts count as empty and have only the end id. NULL ids come first; rows of one id are ordered by text.
An empty table gives a dataset without partitions. Other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm.encoding import encoder

#: Documents that are encoded at once.
_CHUNK = 256


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" not in folder:
        folder = folder.removeprefix("file:")
        return (fs.LocalFileSystem(), folder) if folder.startswith("/") else fs.FileSystem.from_uri(folder)
    return fs.FileSystem.from_uri(folder)


def _names(path: str, part: int) -> list[str]:
    return [f"{path}/part-{part:06d}.{kind}" for kind in ("ids", "offsets", "docs")]


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, end_id: int, size: int) -> dict:
    """Encode ``docs`` (doc_id, text), write the dataset and return its manifest.

    ``vocabulary``: file of the tokenizer; ``size``: number of its ids; ``end_id`` closes each document.
    """
    width = 2 if max(size, end_id + 1) <= 1 << 16 else 4
    filesystem, path = _filesystem(folder)
    filesystem.create_dir(path, recursive=True)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        where, path = _filesystem(folder)
        names = _names(path, part)
        own = [f"{name}.{attempt}" for name in names]
        encode, offsets, count = encoder(vocabulary, end_id), [np.zeros(1, "<i8")], 0
        seen = None
        with where.open_output_stream(own[0]) as ids_out, where.open_output_stream(own[2]) as docs_out:
            for batch in batches:
                if seen is None:
                    seen = pa.ipc.new_file(docs_out, pa.schema([batch.schema.field("doc_id")]))
                seen.write_batch(batch.select(["doc_id"]))
                for begin in range(0, batch.num_rows, _CHUNK):
                    texts = batch.column("text").slice(begin, _CHUNK).to_pylist()
                    ids, bounds = encode.encode(texts)
                    ids_out.write(ids.astype(f"<u{width}").tobytes())
                    offsets.append(bounds[1:].astype("<i8") + count)
                    count += len(ids)
            if seen is not None:
                seen.close()
        with where.open_output_stream(own[1]) as out:
            out.write(np.concatenate(offsets).tobytes())
        if seen is None:
            for name in own:
                where.delete_file(name)
            return
        for name, final in zip(own, names):
            where.move(name, final)
        n_docs = sum(map(len, offsets)) - 1
        yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [n_docs], "n_tokens": [count]})

    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    # One row per partition comes back to the driver.
    parts = sorted(ordered.mapInArrow(write, "part long, n_docs long, n_tokens long").collect())
    base, listed = 0, []
    for part, n_docs, n_tokens in parts:
        listed.append({"part": part, "base": base, "n_docs": n_docs, "n_tokens": n_tokens})
        base += n_tokens
    manifest = {"width": width, "end_id": end_id, "doc_id": kind, "n_tokens": base, "parts": listed}
    with filesystem.open_output_stream(f"{path}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def open_part(folder: str, part: int, width: int) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """Ids, offsets and document ids of a partition; ids are mapped, not read, from a local path."""
    where, path = _filesystem(folder)
    names = _names(path, part)
    if isinstance(where, fs.LocalFileSystem):
        ids, offsets = np.memmap(names[0], f"<u{width}", "r"), np.memmap(names[1], "<i8", "r")
    else:
        read = lambda name: where.open_input_file(name).read()
        ids, offsets = np.frombuffer(read(names[0]), f"<u{width}"), np.frombuffer(read(names[1]), "<i8")
    with where.open_input_file(names[2]) as file:
        return ids, offsets, pa.ipc.open_file(file).read_all()


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a dataset: doc_id, start (ids before it in the dataset), ids (uint32, little-endian)."""
    where, path = _filesystem(folder)
    with where.open_input_stream(f"{path}/manifest.json") as file:
        manifest = json.loads(file.read())
    width = manifest["width"]
    schema = f"doc_id {manifest['doc_id']}, start long, ids binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets, ids_of = open_part(folder, row["part"], width)
                names = ids_of.column("doc_id").combine_chunks()
                for begin in range(0, len(names), _CHUNK):
                    at = offsets[begin : begin + _CHUNK + 1]
                    found = [ids[a:b].astype("<u4").tobytes() for a, b in zip(at[:-1], at[1:])]
                    start = pa.array(row["base"] + at[:-1], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [names.slice(begin, _CHUNK), start, pa.array(found, pa.binary())], ["doc_id", "start", "ids"]
                    )

    parts = [(p["part"], p["base"]) for p in manifest["parts"]]
    return spark.createDataFrame(parts, "part long, base long").mapInArrow(read, schema)
