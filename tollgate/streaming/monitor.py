"""Progress of the streaming jobs, kept in a table.

Every finished micro-batch of every query in the session gives one row: rows in, rates, what its watermark refused, and
the metrics that the job observes (``ingest`` and ``relay``), such as counts of both outcomes and the 95th percentile
of the lag. Rows are written in groups, and when a query ends.
"""

from __future__ import annotations

import threading
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import DoubleType, LongType, MapType, StringType, StructField, StructType, TimestampType

PROGRESS = StructType(
    [
        StructField("query", StringType()), StructField("run_id", StringType()), StructField("batch_id", LongType()),
        StructField("progress_time", TimestampType()), StructField("input_rows", LongType()),
        StructField("input_rows_per_second", DoubleType()), StructField("processed_rows_per_second", DoubleType()),
        StructField("late_rows", LongType()), StructField("metrics", MapType(StringType(), DoubleType())),
    ]
)


class Monitor(StreamingQueryListener):
    """Register with ``spark.streams.addListener``; ``flush`` writes what is still held."""

    def __init__(self, spark: SparkSession, table: str, group: int = 60):
        self._spark, self._table, self._group = spark, table, group
        self._held: list[tuple] = []
        self._lock = threading.Lock()

    @staticmethod
    def create_table(spark: SparkSession, table: str) -> None:
        spark.createDataFrame([], PROGRESS).write.format("parquet").saveAsTable(table)

    def flush(self) -> None:
        with self._lock:
            rows, self._held = self._held, []
        if rows:
            self._spark.createDataFrame(rows, PROGRESS).coalesce(1).write.insertInto(self._table)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        observed = {
            f"{name}.{key}": float(value)
            for name, row in p.observedMetrics.items()
            for key, value in row.asDict().items()
            if value is not None
        }
        late = sum(state.numRowsDroppedByWatermark for state in p.stateOperators)
        at = datetime.fromisoformat(p.timestamp).astimezone(timezone.utc)
        row = (p.name, str(p.runId), p.batchId, at, p.numInputRows, p.inputRowsPerSecond, p.processedRowsPerSecond, late, observed)
        with self._lock:
            self._held.append(row)
            full = len(self._held) >= self._group
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.flush()
