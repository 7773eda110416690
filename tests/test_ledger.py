"""The commit ledger, atomic batches, key-sliced backfills and the identity of rebuilt error rows."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import SF001
from streamload import SpecError
from streamload.operators.audit import latest_offsets, read_audit
from streamload.operators.ledger import AUDITED, STEPS, find_entry, latest_entries, read_ledger
from streamload.plans.batch import process_batch, read_committed, run_slices
from streamload.sources import existing_rows_from_events, messages_from_events, read_replay, write_replay
from streamload.sources.feed import event_spec
from streamload.sources.target import read_rows
from streamload.sinks import append_parquet
from streamload.streaming import make_batch_processor, run_stream


class Stop(Exception):
    pass


def stop_at(step, batch=0):
    seen = []

    def on_step(done):
        seen.append(done)
        if done == step and seen.count(step) > batch:
            raise Stop(step)
    return on_step


@pytest.fixture(scope="module")
def msgs(spark):
    return messages_from_events(spark.read.parquet(f"{SF001}/events.parquet")).cache()


@pytest.fixture()
def seeded(spark, workdir):
    append_parquet(existing_rows_from_events(spark.read.parquet(f"{SF001}/events.parquet")), f"{workdir}/target", "audit_load_date")
    return workdir


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


PLAIN = {}


def plain(spark, msgs, root, form="", **changes):
    """What one batch without any of it leaves: target and errors; worked out once for each form of the messages."""
    key = (form, repr(sorted(changes.items())))
    if key not in PLAIN:
        if form == "seeded":
            append_parquet(existing_rows_from_events(spark.read.parquet(f"{SF001}/events.parquet")), f"{root}/plain", "audit_load_date")
        process_batch(msgs, 0, event_spec(f"{root}/plain", f"{root}/plain_errors", **changes))
        PLAIN[key] = rows(read_rows(spark, f"{root}/plain")), rows(read_rows(spark, f"{root}/plain_errors"))
    return PLAIN[key]


@pytest.mark.parametrize("mode,step", [*(("reprocess", s) for s in STEPS), ("always", "data")])
def test_a_batch_that_stops_at_any_step_is_loaded_once(spark, msgs, workdir, mode, step):
    spec = event_spec(f"{workdir}/t", f"{workdir}/e", dedup_mode=mode, ledger_path=f"{workdir}/ledger", audit_path=f"{workdir}/audit")
    with pytest.raises(Stop):
        process_batch(msgs, 3, spec, run_id="r", on_step=stop_at(step))
    m = process_batch(msgs, 3, spec, run_id="r")
    want, want_errors = plain(spark, msgs, workdir)
    assert rows(read_rows(spark, f"{workdir}/t")) == want
    assert rows(read_rows(spark, f"{workdir}/e")) == want_errors
    audit = read_audit(spark, f"{workdir}/audit").collect()
    assert len(audit) == 1 and audit[0]["n_in"] == msgs.count()
    assert m.n_in == m.n_bad + m.n_filtered + m.n_duplicate + m.n_written
    if step in ("errors", "audited"):  # the ledger knows that the rows had been appended, and how many
        assert m.n_written == len(want) and audit[0]["n_written"] == len(want)
    again = process_batch(msgs, 3, spec, run_id="r")
    assert again.resumed_from == AUDITED and rows(read_rows(spark, f"{workdir}/t")) == want


def test_what_is_done_is_not_compared(spark, msgs, workdir):
    """A batch noted past its data step is not joined with the target: it writes nothing, whatever the target holds."""
    spec = event_spec(f"{workdir}/t", f"{workdir}/e", ledger_path=f"{workdir}/ledger", dedup_mode="reprocess")
    with pytest.raises(Stop):
        process_batch(msgs, 0, spec, run_id="r", on_step=stop_at("errors"))
    assert find_entry(spark, f"{workdir}/ledger", spec.app_name, "r", 0).step == "data"
    m = process_batch(msgs.limit(0).unionByName(msgs), 0, spec.with_(target=event_spec(f"{workdir}/elsewhere").target), run_id="r")
    assert m.resumed_from == "data" and read_rows(spark, f"{workdir}/elsewhere") is None


def test_batches_and_runs_are_kept_apart(spark, msgs, workdir):
    spec = event_spec(f"{workdir}/t", f"{workdir}/e", ledger_path=f"{workdir}/ledger")
    process_batch(msgs.filter("partition = 0"), 0, spec, run_id="a/b=c")
    process_batch(msgs.filter("partition = 1"), 1, spec, run_id="a/b=c")
    process_batch(msgs.filter("partition >= 2"), 0, spec, run_id="other")
    entries = latest_entries(read_ledger(spark, f"{workdir}/ledger"))
    assert rows(entries.select("run_id", "batch_id", "step")) == [("a/b=c", 0, AUDITED), ("a/b=c", 1, AUDITED), ("other", 0, AUDITED)]
    assert rows(read_rows(spark, f"{workdir}/t")) == plain(spark, msgs, workdir)[0]
    with pytest.raises(SpecError, match="run_id"):
        process_batch(msgs, 0, spec)


@pytest.mark.parametrize("ledger,step", [(False, "data"), (True, "data"), (True, "audited")])
def test_a_stream_restarted_with_its_checkpoint_loads_once(spark, msgs, seeded, ledger, step):
    write_replay(msgs, f"{seeded}/replay", files=4)
    spec = event_spec(f"{seeded}/target", f"{seeded}/errors", dedup_mode="reprocess", ledger_path=f"{seeded}/ledger" if ledger else None)

    def start(**more):
        run_stream(read_replay(spark, f"{seeded}/replay", max_files_per_trigger=2), spec, checkpoint=f"{seeded}/checkpoint",
                   trigger={"availableNow": True}, await_termination=True, **more)
    with pytest.raises(StreamingQueryException):
        start(reprocess=True, on_step=stop_at(step, 1))
    start()
    assert rows(read_rows(spark, f"{seeded}/target")) == plain(spark, msgs, seeded, "seeded")[0]


def test_only_the_first_batch_of_a_start_compares(spark, msgs, workdir):
    seen = []
    fn = make_batch_processor(event_spec(f"{workdir}/t", dedup_mode="reprocess"), on_metrics=seen.append)
    for k in range(3):
        fn(msgs.filter(f"partition = {k}"), k)
    assert [m.dedup_applied for m in seen] == [True, False, False]
    with pytest.raises(ValueError):
        make_batch_processor(event_spec("t"), reprocess="sometimes")


@pytest.mark.parametrize("step", ["data", "errors", "audited"])
def test_readers_see_whole_batches_only(spark, msgs, seeded, step):
    spec = event_spec(f"{seeded}/target", f"{seeded}/errors", ledger_path=f"{seeded}/ledger", audit_path=f"{seeded}/audit", atomic=True)
    seed = rows(read_committed(spark, spec))
    assert len(seed) and read_committed(spark, spec, "errors") is None
    first, second = msgs.filter("partition < 2"), msgs.filter("partition >= 2")
    process_batch(first, 0, spec, run_id="r")
    before = rows(read_committed(spark, spec)), rows(read_committed(spark, spec, "errors"))
    with pytest.raises(Stop):
        process_batch(second, 1, spec, run_id="r", on_step=stop_at(step))
    assert (rows(read_committed(spark, spec)), rows(read_committed(spark, spec, "errors"))) == before
    offsets = read_audit(spark, f"{seeded}/audit", ledger_path=f"{seeded}/ledger")
    assert {r.kafka_partition for r in latest_offsets(offsets).collect()} == {0, 1}
    m = process_batch(second, 1, spec, run_id="r")  # another attempt, which the stopped one does not disturb
    assert m.n_written and m.n_bad_written
    want, want_errors = plain(spark, msgs, seeded, "seeded")
    assert rows(read_committed(spark, spec)) == want
    assert rows(read_committed(spark, spec, "errors")) == want_errors
    assert process_batch(second, 1, spec, run_id="r").resumed_from == AUDITED


def test_atomic_batches_need_a_ledger_and_a_path(workdir):
    with pytest.raises(SpecError, match="ledger"):
        event_spec("t", atomic=True)


def spread(msgs):
    """Copies of a third of the keys, of another event type, in another partition; every eleventh message has no offset."""
    copies = msgs.filter("offset % 3 = 0").withColumns({
        "partition": (F.col("partition") + 1) % 4, "offset": F.col("offset") + 7_000_000,
        "value": F.regexp_replace(F.col("value").cast("string"), '"kind": "', '"kind": "copy-').cast("binary")})
    return msgs.withColumn("offset", F.when(F.col("offset") % 11 != 5, F.col("offset"))).unionByName(copies)


def same(df, params):
    return df


@pytest.mark.parametrize("slices,changes", [(1, {}), (4, {"reserialize_null_key_rows": True}),
                                            (3, {"transformer": same, "reserialize_null_key_rows": True})])
def test_a_sliced_backfill_equals_one_batch(spark, msgs, workdir, changes, slices):
    raw = spread(msgs)
    spec = event_spec(f"{workdir}/t", f"{workdir}/e", audit_path=f"{workdir}/audit", **changes)
    found = run_slices(raw, spec, slices)
    want, want_errors = plain(spark, raw, workdir, "spread", **changes)
    assert rows(read_rows(spark, f"{workdir}/t")) == want
    assert rows(read_rows(spark, f"{workdir}/e")) == want_errors
    one = process_batch(raw, 0, event_spec(f"{workdir}/t2", f"{workdir}/e2", **changes))
    for name in ("n_in", "n_parse_failure", "n_null_key", "n_filtered", "n_duplicate", "n_written", "n_bad_written"):
        assert sum(getattr(m, name) for m in found) == getattr(one, name), name
    audit = read_audit(spark, f"{workdir}/audit")
    assert rows(audit.select("n_in", "n_written")) == [(one.n_in, one.n_written)]
    assert rows(latest_offsets(audit).select("kafka_partition", "next_offset")) == rows(
        raw.groupBy("partition").agg(F.max("offset") + 1))


def test_a_sliced_backfill_goes_on_where_it_stopped(spark, msgs, workdir):
    spec = event_spec(f"{workdir}/t", f"{workdir}/e", audit_path=f"{workdir}/audit", ledger_path=f"{workdir}/ledger", dedup_mode="reprocess")
    with pytest.raises(Stop):
        run_slices(spread(msgs), spec, 4, run_id="backfill", on_step=stop_at("data", 2))
    assert read_audit(spark, f"{workdir}/audit") is None  # offsets are done with the last slice
    found = run_slices(spread(msgs), spec, 4, run_id="backfill")
    assert [m.resumed_from for m in found] == [AUDITED, AUDITED, "begun", None]
    want, want_errors = plain(spark, spread(msgs), workdir, "spread")
    assert rows(read_rows(spark, f"{workdir}/t")) == want and rows(read_rows(spark, f"{workdir}/e")) == want_errors
    assert read_audit(spark, f"{workdir}/audit").first()["n_in"] == spread(msgs).count()


def keyless(spark, offsets, text='{"props": {"k": 1}}'):
    return spark.createDataFrame([(None, text, "events", 0, o, None, 0) for o in offsets],
                                 "key string, value string, topic string, partition int, offset long, timestamp timestamp, timestampType int") \
        .withColumns({"key": F.col("key").cast("binary"), "value": F.col("value").cast("binary")})


def test_two_messages_of_one_text_are_two_errors_however_they_arrive(spark, workdir):
    for form, batches in (("one", [[1, 2]]), ("two", [[1], [2]])):
        spec = event_spec(f"{workdir}/t", f"{workdir}/{form}", reserialize_null_key_rows=True)
        for k, offsets in enumerate([*batches, [1, 2]]):  # and a replay
            m = process_batch(keyless(spark, offsets), k, spec)
            assert m.n_bad_written == (len(offsets) if k < len(batches) else 0)
        got = read_rows(spark, f"{workdir}/{form}")
        assert rows(got.select("json_raw", "kafka_offset", "src_topic", "src_partition", "src_offset")) == [
            ('{"k":1}', -1, "events", 0, o) for o in (1, 2)]


def test_rebuilt_errors_meet_older_files_without_the_identity(spark, workdir):
    spec = event_spec(f"{workdir}/t", f"{workdir}/e")
    process_batch(keyless(spark, [1, 2]), 0, spec)  # seven columns, known by the envelope
    m = process_batch(keyless(spark, [2, 3]), 1, spec.with_(reserialize_null_key_rows=True))
    assert m.n_bad_written == 1
    assert process_batch(keyless(spark, [1, 2, 3]), 2, spec).n_bad_written == 0


def test_errors_without_a_position_are_never_matched(spark, workdir):
    def drop(df, params):
        return df.drop("_src")
    spec = event_spec(f"{workdir}/t", f"{workdir}/e", transformer=drop)
    for k in range(2):
        assert process_batch(keyless(spark, [1, 2]), k, spec).n_bad_written == 2  # at least once
    assert process_batch(keyless(spark, [None, None]), 3, event_spec(f"{workdir}/t", f"{workdir}/e2")).n_bad_written == 2
