"""What the engine says of each micro-batch, as a table."""

from __future__ import annotations

import json
import threading
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

FACTS = (
    "stream_id string, run_id string, batch_id bigint, started_at string, n_input_rows bigint, "
    "millis bigint, sources array<string>, sink string, state_rows bigint, watermark string, observed string"
)
#: So many of the newest micro-batches are remembered between two calls of ``save``.
REMEMBERED = 10_000


class MicroBatchFacts(StreamingQueryListener):
    """Collects a row per micro-batch: what was read, how long it took, what was observed while it wrote.

    Register it with ``spark.streams.addListener``. Callbacks only take notes; ``save``
    appends them to a table, from whoever runs the stream.
    """

    def __init__(self) -> None:
        self._rows: deque[tuple] = deque(maxlen=REMEMBERED)
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {name: row.asDict() for name, row in (p.observedMetrics or {}).items()}
        row = (
            str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows, p.durationMs.get("triggerExecution", 0),
            [s.description for s in p.sources], p.sink.description, sum(s.numRowsTotal for s in p.stateOperators),
            (p.eventTime or {}).get("watermark"), json.dumps(observed, default=str),
        )
        with self._lock:
            self._rows.append(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def facts(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            return spark.createDataFrame(list(self._rows), FACTS)

    def save(self, spark: SparkSession, path: str) -> None:
        with self._lock:
            rows, self._rows = list(self._rows), deque(maxlen=REMEMBERED)
        spark.createDataFrame(rows, FACTS).coalesce(1).write.mode("append").parquet(path)
