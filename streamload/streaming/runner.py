"""Structured Streaming wrapper (STR-1 … STR-4, STR-6 … STR-9, AUD-2 … AUD-4).

State lives in the target (dedup) and in Spark's checkpoint (offsets);
the checkpoint is never deleted by this library.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.batch import BatchMetrics, process_batch
from ..spec import PipelineSpec


#: ``reprocess`` value: the first batch of a start compares with the target.
FIRST = "first"


def make_batch_processor(spec: PipelineSpec, *, on_metrics: Callable[[BatchMetrics], None] | None = None,
                         reprocess: bool | str | Callable[[int], bool] = FIRST, persist: bool = True,
                         on_step: Callable[[str], None] | None = None) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` body (STR-2): process, then report metrics.

    ``reprocess`` (bool, a function of the batch id, or ``"first"``) tells a ``dedup_mode="reprocess"`` pipeline
    whether the batch may repeat what is stored.  The first batch of a start may: Spark runs the last batch again
    unless its commit is in the checkpoint, and its rows may have been appended just before the stop.  With a ledger
    that first batch is looked up instead, and compares only if it had begun.
    """
    if isinstance(reprocess, str) and reprocess != FIRST:
        raise ValueError(f"reprocess must be a bool, a function of the batch id or {FIRST!r}")
    done = []

    def fn(df: DataFrame, batch_id: int) -> None:
        first = not done
        if reprocess == FIRST:
            again = first and not spec.ledger_path
        else:
            again = reprocess(batch_id) if callable(reprocess) else reprocess
        # the id of the query, which stays with its checkpoint
        run = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        m = process_batch(df, batch_id, spec, persist=persist, reprocess=again, run_id=run, resume=first, on_step=on_step)
        done[:] = [batch_id]
        if on_metrics is not None:
            on_metrics(m)
    return fn


def run_stream(source: DataFrame, spec: PipelineSpec, *, checkpoint: str,
               trigger: Mapping[str, Any] | None = None, query_name: str | None = None,
               on_metrics: Callable[[BatchMetrics], None] | None = None,
               reprocess: bool | str | Callable[[int], bool] = FIRST, await_termination: bool = False,
               on_step: Callable[[str], None] | None = None) -> StreamingQuery:
    """Start the pipeline over a streaming source (STR-1, STR-3, STR-4).

    ``trigger`` is passed to ``DataStreamWriter.trigger``: e.g.
    ``{"processingTime": "15 minutes"}`` or ``{"availableNow": True}``.
    Empty micro-batches do no work beyond one ``isEmpty``.
    """
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    w = source.writeStream.foreachBatch(
        make_batch_processor(spec, on_metrics=on_metrics, reprocess=reprocess, on_step=on_step)
    ).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**dict(trigger))
    if query_name:
        w = w.queryName(query_name)
    q = w.start()
    if await_termination:
        q.awaitTermination()
    return q
