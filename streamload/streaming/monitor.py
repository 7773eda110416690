"""Progress that outlives the driver (STR-6): every listener event as a row of a table.

:class:`ProgressTable` is a streaming listener.  It turns each ``onQueryProgress`` into a row of one flat schema and hands it
to a writer thread, so the listener bus never waits for a write.  The thread appends what has come since its last write as
one Parquet file in the folder of the query and the day; a driver that dies loses at most the events that were still on
their way.  Starts and ends of queries are rows of the same table.  Old days can be compacted like the audit.
"""

from __future__ import annotations

import datetime as _dt
import json
import queue
import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from ..sinks.compaction import compact, dataset_folders
from ..sources.target import read_target

PROGRESS_SCHEMA = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("query_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("event", T.StringType()),            # started | progress | terminated
    T.StructField("batch_id", T.LongType()),
    T.StructField("at", T.TimestampType()),
    T.StructField("num_input_rows", T.LongType()),
    T.StructField("input_rows_per_second", T.DoubleType()),
    T.StructField("processed_rows_per_second", T.DoubleType()),
    T.StructField("duration_ms", T.MapType(T.StringType(), T.LongType())),
    T.StructField("end_offsets", T.StringType()),      # JSON list, one entry per source
    T.StructField("error", T.StringType()),
    T.StructField("event_date", T.StringType()),
])
# Folder levels of the progress table.
PROGRESS_PARTITIONS = ("query", "event_date")


def _time(text: str | None) -> _dt.datetime:
    if text is None:
        return _dt.datetime.now(_dt.timezone.utc)
    return _dt.datetime.fromisoformat(text.replace("Z", "+00:00"))


class ProgressTable(StreamingQueryListener):
    """Appends progress events to ``path``; register it with ``spark.streams.addListener``, and ``close`` it at the end."""

    def __init__(self, spark: SparkSession, path: str, queries: Sequence[str] | None = None):
        super().__init__()
        self.spark, self.path, self.queries = spark, path, queries
        self.errors: list[Exception] = []
        self._names: dict[str, str] = {}
        self._rows: queue.Queue = queue.Queue()
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()
        self._thread = threading.Thread(target=self._write_all, name="progress-table", daemon=True)
        self._thread.start()

    # ---- events

    def _put(self, query_id, run_id, event: str, at: _dt.datetime, name: str | None = None, **more) -> None:
        query_id, run_id = str(query_id), str(run_id)
        if name is not None:
            self._names[query_id] = name
        name = self._names.get(query_id, query_id)
        if self.queries is None or name in self.queries:
            row = dict.fromkeys(PROGRESS_SCHEMA.fieldNames())
            row.update(query=name, query_id=query_id, run_id=run_id, event=event, at=at, event_date=at.date().isoformat(), **more)
            self._rows.put(row)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's name
        self._put(event.id, event.runId, "started", _time(event.timestamp), event.name)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self._put(p.id, p.runId, "progress", _time(p.timestamp), p.name, batch_id=p.batchId, num_input_rows=p.numInputRows,
                  input_rows_per_second=p.inputRowsPerSecond, processed_rows_per_second=p.processedRowsPerSecond,
                  duration_ms={k: int(v) for k, v in (p.durationMs or {}).items()},
                  end_offsets=json.dumps([str(s.endOffset) for s in p.sources]))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._put(event.id, event.runId, "terminated", _time(None), error=event.exception)
        self._end_of(str(event.runId)).set()

    def _end_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    # ---- the writer

    def _write_all(self) -> None:
        while True:
            rows = [self._rows.get()]
            while not self._rows.empty():
                rows.append(self._rows.get_nowait())
            found = [r for r in rows if isinstance(r, dict)]
            try:
                if found:
                    self.spark.createDataFrame([tuple(r[f] for f in PROGRESS_SCHEMA.fieldNames()) for r in found], PROGRESS_SCHEMA) \
                        .coalesce(1).write.mode("append").partitionBy(*PROGRESS_PARTITIONS).parquet(self.path)
            except Exception as e:  # noqa: BLE001 - monitoring must not end the query; the caller sees it in close()
                self.errors.append(e)
            for r in rows:
                if not isinstance(r, dict):
                    r.set()
                    if r is self._last:
                        return

    _last: threading.Event | None = None

    def flush(self, timeout: float = 60.0) -> bool:
        """Wait until the events received so far are stored."""
        done = threading.Event()
        self._rows.put(done)
        return done.wait(timeout)

    def wait_for(self, query, timeout: float = 60.0) -> bool:
        """Wait until the end of a query has been received, and with it all its progress; then store it."""
        return self._end_of(str(query.runId)).wait(timeout) and self.flush(timeout)

    def close(self, timeout: float = 60.0) -> None:
        """Store what is left and end the writer; raises what a write raised."""
        self._last = threading.Event()
        self._rows.put(self._last)
        self._last.wait(timeout)
        if self.errors:
            raise self.errors[0]


def read_progress(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored events, each once; None before the first write."""
    found = [read_target(spark, folder, schema=PROGRESS_SCHEMA) for folder in dataset_folders(spark, path)]
    found = [df for df in found if df is not None]
    if not found:
        return None
    df = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    key = ("query", "query_id", "run_id", "event", "batch_id", "at")
    rest = [f.name for f in PROGRESS_SCHEMA.fields if f.name not in key]
    one = df.groupBy(*key).agg(F.first(F.struct(*rest)).alias("r"))
    return one.select(*[F.col(f.name) if f.name in key else F.col(f"r.{f.name}").alias(f.name) for f in PROGRESS_SCHEMA.fields])


def compact_progress(spark: SparkSession, path: str, before: _dt.date) -> int | None:
    return compact(spark, path, PROGRESS_SCHEMA, PROGRESS_PARTITIONS, F.col("event_date") < before.isoformat())
