"""Progress monitoring (STR-6): Spark's listener events plus our batch counts."""

from __future__ import annotations

import threading
from collections import deque
from typing import Any

from pyspark.sql.streaming import StreamingQueryListener

from ..plans.batch import BatchMetrics


# Stage counts summed by :meth:`ProgressRecorder.totals`.
TOTAL_KEYS = ("n_in", "n_parse_failure", "n_null_key", "n_filtered", "n_duplicate_in_batch",
              "n_duplicate_target", "n_written", "n_bad_written")


class ProgressRecorder(StreamingQueryListener):
    """Collects per-batch progress (duration, input rate) and :class:`BatchMetrics`.

    Register with ``spark.streams.addListener(rec)``; pass ``rec.add_metrics``
    as ``on_metrics`` to :func:`run_stream`.  A stream may run for months, so
    only the last ``keep`` entries of each kind stay on the driver, older
    ones are forgotten; the totals are running sums over every batch seen.
    The full record of all batches is the audit dataset (``audit_path``).
    """

    def __init__(self, keep: int = 1000):
        super().__init__()
        self._lock = threading.Lock()
        self.progress: deque[dict[str, Any]] = deque(maxlen=keep)
        self.metrics: deque[BatchMetrics] = deque(maxlen=keep)
        self.terminated: deque[str | None] = deque(maxlen=keep)
        self.batches_seen = 0
        self._totals = dict.fromkeys(TOTAL_KEYS, 0)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's name
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        with self._lock:
            self.progress.append({
                "id": str(p.id), "batch_id": p.batchId, "num_input_rows": p.numInputRows,
                "input_rows_per_second": p.inputRowsPerSecond,
                "processed_rows_per_second": p.processedRowsPerSecond,
                "duration_ms": dict(p.durationMs or {}),
            })

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._lock:
            self.terminated.append(event.exception)

    def add_metrics(self, m: BatchMetrics) -> None:
        with self._lock:
            self.metrics.append(m)
            self.batches_seen += 1
            for k in TOTAL_KEYS:
                self._totals[k] += int(getattr(m, k) or 0)

    def totals(self) -> dict[str, int]:
        """Stage counts summed over every batch recorded (not only the kept ones)."""
        with self._lock:
            return dict(self._totals)
