"""Progress of running streams as table rows."""

from __future__ import annotations

import json
import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = """stream_name string, batch_id long, input_rows long, input_rows_per_second double,
    events_per_second double, batch_ms long"""


def _row(name: str, p: dict) -> tuple:
    duration = p.get("durationMs") or {}
    return (
        name,
        int(p["batchId"]),
        int(p["numInputRows"]),
        float(p.get("inputRowsPerSecond") or 0.0),
        float(p.get("processedRowsPerSecond") or 0.0),
        int(duration.get("triggerExecution") or 0),
    )


class ProgressWriter(StreamingQueryListener):
    """Appends every report to a parquet table as it comes in."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = _row(p.name or str(p.id), json.loads(p.json))
        self._spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("append").parquet(self._path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()
