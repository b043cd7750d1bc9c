"""What running streams report, kept as a table.

A listener appends a row for each batch of each query: rows read, rows and rejected
rows as the job observed them, state size, watermark and time taken. The table outlives
the queries and is read like any other.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("query_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("started_at", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("state_rows", T.LongType()),
        T.StructField("late_rows", T.LongType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("batch_ms", T.LongType()),
    ]
)


class ProgressTable(StreamingQueryListener):
    """Appends progress to the folder ``path``, ``every`` reports a file, and when a query ends."""

    def __init__(self, spark: SparkSession, path: str, every: int = 20):
        self._spark, self.path, self._every = spark, path, every
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._changed = threading.Condition()
        spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        told = json.loads(event.progress.json)
        seen = told.get("observedMetrics", {}).get("changes", {})
        states = told.get("stateOperators", [])
        row = (
            told.get("name"),
            told["id"],
            told["runId"],
            told["batchId"],
            told["timestamp"],
            told.get("numInputRows", 0),
            seen.get("rows"),
            seen.get("rejected"),
            sum(s.get("numRowsTotal", 0) for s in states) if states else None,
            sum(s.get("numRowsDroppedByWatermark", 0) for s in states) if states else None,
            told.get("eventTime", {}).get("watermark"),
            told.get("durationMs", {}).get("triggerExecution"),
        )
        with self._changed:
            self._rows.append(row)
            full = len(self._rows) >= self._every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def flush(self) -> None:
        with self._changed:
            rows, self._rows = self._rows, []
        if rows:
            self._spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def wait_for(self, run_id: str, seconds: float = 60) -> bool:
        """Wait until everything a run has reported is in the table."""
        with self._changed:
            return self._changed.wait_for(lambda: str(run_id) in self._ended, seconds)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def throughput(progress: DataFrame) -> DataFrame:
    """Per query: batches that read something, rows, rejected rows, largest state and rows a second."""
    busy = progress.filter("input_rows > 0")
    return busy.groupBy("name", "query_id").agg(
        F.count_distinct("run_id", "batch_id").alias("batches"),
        F.sum("rows").alias("rows"),
        F.sum("rejected").alias("rejected"),
        F.max("state_rows").alias("state_rows"),
        (F.sum("input_rows") * 1000 / F.sum("batch_ms")).alias("rows_a_second"),
    )
