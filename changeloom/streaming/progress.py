"""Progress of streams as audit rows: rows, start and duration of every micro-batch.

Spark reports progress to a listener, on a thread of its own. The listener only keeps the reports; the thread
that waits for the streams writes them, a small file whenever enough have come or some time has passed. A
driver that dies loses the reports since the last write, never a row of data.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from changeloom.sinks.audit import write_audit

# Columns of the progress table, in order.
STREAM_PROGRESS = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("query_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("batch_start", T.TimestampType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("duration_ms", T.LongType()),
    ]
)


class ProgressAudit(StreamingQueryListener):
    """Collects the progress of the queries it is told of and writes it below ``path``.

    ``input_rows`` counts the rows that the batch scanned; a batch that Spark had to scan again, because an
    executor that kept it was lost, counts them again. The run log holds the exact counts.
    """

    def __init__(self, spark: SparkSession, path: str, name: str | None = None, *, every_rows: int = 500, every_seconds: float = 60):
        self._spark, self._path, self._name = spark, path, name
        self._every_rows, self._every_seconds = every_rows, every_seconds
        self._changed = threading.Condition()
        self._reports: list[dict] = []
        self._watched: set[str] = set()
        self._ended: set[str] = set()
        self._written = time.monotonic()

    def watch(self, query: StreamingQuery) -> None:
        with self._changed:
            self._watched.add(str(query.id))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        report = {
            "stream": progress.name,
            "query_id": str(progress.id),
            "run_id": str(progress.runId),
            "batch_id": progress.batchId,
            "batch_start": progress.timestamp,
            "input_rows": progress.numInputRows,
            "duration_ms": progress.durationMs.get("triggerExecution", 0),
        }
        with self._changed:
            self._reports.append(report)

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def flush(self, *, force: bool = False) -> None:
        """Write what has come, once it is enough or due; other sessions' streams are left out."""
        due = force or time.monotonic() - self._written >= self._every_seconds
        with self._changed:
            if not self._reports or not (due or len(self._reports) >= self._every_rows):
                return
            taken, self._reports = self._reports, []
            reports = [r for r in taken if r["query_id"] in self._watched]
        self._written = time.monotonic()
        if reports:
            # as one constant, which Spark reads while it plans
            text = F.lit(json.dumps(reports))
            rows = self._spark.sql("SELECT 1").select(F.inline(F.from_json(text, T.ArrayType(STREAM_PROGRESS))))
            write_audit(rows, self._path, uuid.uuid4().hex, self._name)

    def finish(self, queries: Sequence[StreamingQuery], timeout: float = 30) -> None:
        """Write the rest, once the listener has heard of the end of every query."""
        wanted = {str(query.runId) for query in queries}
        with self._changed:
            self._changed.wait_for(lambda: wanted <= self._ended, timeout)
        self.flush(force=True)


def stream_latency(progress: DataFrame, target_seconds: float = 120) -> DataFrame:
    """Batches, rows, largest batch and longest batch per stream, and whether that met the target.

    A batch counts once, as it was reported last, however often it was tried.
    """
    last = progress.groupBy("stream", "query_id", "batch_id").agg(
        F.max_by(F.struct("input_rows", "duration_ms"), F.struct("batch_start", "run_id")).alias("_last")
    )
    longest = F.max("_last.duration_ms") / F.lit(1000.0)
    return last.groupBy("stream").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("_last.input_rows").alias("input_rows"),
        F.max("_last.input_rows").alias("largest_batch"),
        longest.alias("longest_seconds"),
        (longest < F.lit(target_seconds)).alias("meets_target"),
    )
