"""Every micro-batch's rows and processing rate in a table (T9), by a query listener."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_SCHEMA = "run_id string, at string, input_rows bigint, input_rows_per_second double, processed_rows_per_second double, batch_ms bigint, state_rows bigint, late_rows bigint"


class ProgressTable(StreamingQueryListener):
    """Writes one row per batch of the query ``name`` to ``path``/batch_id=N; a batch repeated after a restart replaces its row.

    The query's own progress reports are a short ring on the driver; this
    table keeps all batches.  ``finished`` is set once the query has ended and
    all its reports were written.
    """

    def __init__(self, spark: SparkSession, path: str, name: str) -> None:
        self.spark, self.path, self.name = spark, path, name
        self.run_id: str | None = None
        self.finished = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run_id = str(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.name:
            return
        row = (str(p.runId), p.timestamp, int(p.numInputRows), float(p.inputRowsPerSecond or 0), float(p.processedRowsPerSecond or 0),
               int(p.batchDuration), sum(s.numRowsTotal for s in p.stateOperators), sum(s.numRowsDroppedByWatermark for s in p.stateOperators))
        self.spark.createDataFrame([row], PROGRESS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch_id={p.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run_id:
            self.finished.set()
