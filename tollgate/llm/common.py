"""Shared-folder tables and the word pattern that the operators share."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A session that names none, as in tests, gets a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


_temporary: dict[str, list[str]] = {}


def saved(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there.

    Parquet rather than ``checkpoint()``, so that later steps read only the columns they use. ``discard``
    removes it, unless it is to ``keep``.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    if not keep:
        _temporary.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.saved_at = path
    return table


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop(*tables: DataFrame) -> None:
    """Remove tables that ``saved`` returned, when all that is derived from them has been written."""
    for table in tables:
        _remove(table.sparkSession, table.saved_at)


def discard(spark: SparkSession) -> None:
    """Remove this session's intermediate tables. What was derived from them must have been written."""
    for path in _temporary.pop(spark.sparkContext.applicationId, []):
        _remove(spark, path)


def words(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def n_words(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def pieces(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """Cut text whose words are parted by spaces into pieces of about ``size`` bytes, at spaces only."""
    begin = 0
    while len(data) - begin > size:
        end = data.find(b" ", begin + size)
        if end < 0:
            break
        yield data[begin:end]
        begin = end + 1
    yield data[begin:]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, which may not be installed where they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    with tempfile.NamedTemporaryFile(prefix="llm-package-", suffix=".zip", delete=False) as file:
        file.write(packed.getvalue())
    context.addPyFile(file.name)
    _shipped.add(context.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
