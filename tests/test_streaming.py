from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from streamload.sources import existing_rows_from_events, messages_from_events, read_replay, write_replay
from streamload.sinks import append_parquet
from streamload.sources.feed import event_spec
from streamload.sources.target import read_rows
from streamload.streaming import ProgressRecorder, run_stream


@pytest.fixture(scope="module")
def msgs(spark):
    return messages_from_events(spark.read.parquet(f"{SF001}/events.parquet")).cache()


def run(spark, src, spec, ckpt, rec=None):
    q = run_stream(read_replay(spark, src, max_files_per_trigger=1), spec, checkpoint=ckpt,
                   trigger={"availableNow": True}, on_metrics=rec.add_metrics if rec else None)
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_available_now_micro_batches_and_restart(spark, msgs, workdir):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    append_parquet(existing_rows_from_events(events), f"{workdir}/target", "audit_load_date")
    spec = event_spec(f"{workdir}/target", f"{workdir}/errors")
    src = f"{workdir}/replay"
    write_replay(msgs.filter(F.col("partition") < 2), src, files=3)
    rec = ProgressRecorder()
    spark.streams.addListener(rec)
    try:
        run(spark, src, spec, f"{workdir}/ckpt", rec)
        first = rec.totals()
        assert len(rec.metrics) == 3 and first["n_in"] == msgs.filter(F.col("partition") < 2).count()
        # restart from the same checkpoint: only the new files are read
        write_replay(msgs.filter(F.col("partition") >= 2), src, files=2)
        run(spark, src, spec, f"{workdir}/ckpt", rec)
        assert len(rec.metrics) == 5
        assert rec.totals()["n_in"] == msgs.count()
    finally:
        spark.streams.removeListener(rec)
    # same result as one bounded batch
    from streamload import process_batch
    append_parquet(existing_rows_from_events(events), f"{workdir}/target2", "audit_load_date")
    process_batch(msgs, 0, event_spec(f"{workdir}/target2", f"{workdir}/errors2"))
    a = Counter(tuple(r) for r in read_rows(spark, f"{workdir}/target").collect())
    b = Counter(tuple(r) for r in read_rows(spark, f"{workdir}/target2").collect())
    assert a == b


def test_checkpoint_is_required(spark, msgs, workdir):
    with pytest.raises(ValueError):
        run_stream(read_replay(spark, workdir), event_spec("x"), checkpoint="")


def test_recorder_memory_is_bounded():
    from streamload.plans.batch import BatchMetrics
    rec = ProgressRecorder(keep=3)
    for i in range(10):
        rec.add_metrics(BatchMetrics(i, n_in=5, n_written=2))
    assert len(rec.metrics) == 3 and [m.batch_id for m in rec.metrics] == [7, 8, 9]
    assert rec.batches_seen == 10
    assert rec.totals()["n_in"] == 50 and rec.totals()["n_written"] == 20
