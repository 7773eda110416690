"""Key index, key sketch, compaction, stored progress."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from streamload import SpecError
from streamload.operators import anti_join_existing
from streamload.operators.audit import compact_audit, latest_offsets, read_audit
from streamload.operators.key_index import append_keys, bucket_count, build_key_index, create_key_index, indexed_keys
from streamload.operators.sketch import BITMAP_BITS, build_sketch, share_kept, sketch_keys, sketch_maps
from streamload.plans.batch import process_batch
from streamload.sources import existing_rows_from_events, messages_from_events, read_replay, write_replay
from streamload.sources.feed import event_spec
from streamload.sources.target import read_rows
from streamload.sinks import append_parquet
from streamload.sinks.compaction import current_version
from streamload.streaming import ProgressTable, compact_progress, read_progress, run_stream


@pytest.fixture(scope="module")
def msgs(spark):
    return messages_from_events(spark.read.parquet(f"{SF001}/events.parquet")).cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def threshold(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    yield lambda value: spark.conf.set(name, str(value))
    spark.conf.set(name, old)


# --------------------------------------------------------------------------- key index

@pytest.fixture()
def index(spark, workdir):
    name = "streamload_test_keys"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_no_exchange_over_the_index(spark, index, threshold, workdir):
    threshold(-1)
    stored = spark.range(4000).selectExpr("CAST(id AS STRING) AS a", "id % 7 AS b", "concat('2024-01-0', id % 3 + 1) AS d")
    build_key_index(spark, index, stored, stored.schema, ["a", "b"], "d", buckets=5, path=f"{workdir}/keys")
    append_keys(stored.withColumn("d", F.lit("2024-01-09")), index, ["a", "b"], "d")  # several files for a bucket
    batch = spark.range(0, 9000, 3).selectExpr("CAST(id AS STRING) AS a", "id % 7 AS b", "id AS v")
    for dates in (None, ["2024-01-01", "2024-01-02"]):
        known = indexed_keys(spark, index, ["a", "b"], "d", dates)
        out = anti_join_existing(batch, known.distinct(), ["a", "b"])
        text = plan(out)
        assert text.count("Exchange") == 1 and "Bucketed: true" in text
        side = text[text.index("Exchange"):]
        assert "Range" in side.split("\n")[1] + side.split("\n")[2]  # the batch's side
        want = stored if dates is None else stored.filter(F.col("d").isin(dates))
        assert rows(out) == rows(batch.join(want, ["a", "b"], "left_anti"))
    assert bucket_count(spark, index) == 5


def test_index_gives_the_rows_of_the_target_join_and_follows_it(spark, msgs, index, workdir):
    stored = existing_rows_from_events(spark.read.parquet(f"{SF001}/events.parquet"))
    for name in ("t", "plain"):
        append_parquet(stored, f"{workdir}/{name}", "audit_load_date")
    spec = event_spec(f"{workdir}/t", f"{workdir}/e", key_index=index)
    build_key_index(spark, index, read_rows(spark, f"{workdir}/t"), stored.schema, ["event_id"], "audit_load_date", buckets=3)
    for k, part in enumerate(("partition < 2", "partition >= 1", "true")):
        process_batch(msgs.filter(part), k, spec)
        process_batch(msgs.filter(part), k, event_spec(f"{workdir}/plain", f"{workdir}/plain_e"))
    assert rows(read_rows(spark, f"{workdir}/t")) == rows(read_rows(spark, f"{workdir}/plain"))
    keys = read_rows(spark, f"{workdir}/t").select("event_id", "audit_load_date").distinct()
    assert rows(spark.table(index).select("event_id", "audit_load_date")) == rows(keys)


def test_a_batch_that_stopped_before_its_keys_were_indexed(spark, msgs, index, workdir):
    class Stop(Exception):
        pass

    def stop(step):
        if step == "data":
            raise Stop
    spec = event_spec(f"{workdir}/t", f"{workdir}/e", key_index=index, ledger_path=f"{workdir}/ledger")
    create_key_index(spark, index, existing_rows_from_events(spark.read.parquet(f"{SF001}/events.parquet")).schema, ["event_id"],
                     "audit_load_date", buckets=3)
    with pytest.raises(Stop):
        process_batch(msgs, 0, spec, run_id="r", on_step=stop)
    want = rows(read_rows(spark, f"{workdir}/t"))
    assert want and spark.table(index).count() == 0
    process_batch(msgs, 0, spec, run_id="r")
    process_batch(msgs, 1, spec, run_id="r")
    assert rows(read_rows(spark, f"{workdir}/t")) == want
    assert spark.table(index).count() == len(want)


def test_a_missing_index_raises(spark, msgs, workdir):
    with pytest.raises(SpecError, match="does not exist"):
        process_batch(msgs, 0, event_spec(f"{workdir}/t", key_index="streamload_no_such_index"))
    with pytest.raises(SpecError, match="committed"):
        event_spec("t", key_index="k", ledger_path="l", atomic=True)


# --------------------------------------------------------------------------- sketch

def test_a_sketch_loses_no_key_and_drops_most_others(spark):
    batch = spark.range(3000).selectExpr("CAST(id * 11 AS STRING) AS a", "id AS b")
    batch = batch.unionByName(batch)
    stored = spark.range(100_000).selectExpr("CAST(id AS STRING) AS a", "id DIV 11 AS b", "'2024-01-01' AS d") \
        .unionByName(spark.createDataFrame([(None, None, "2024-01-01")], "a string, b long, d string"))
    for limit in (8_400, 20_000, 300_000):
        sketch = build_sketch(batch, ["a", "b"], limit)
        size = sketch.maps.agg(F.sum(F.octet_length("_bits"))).first()[0]
        assert size <= limit
        kept = sketch_keys(stored, sketch, ["a", "b"])
        assert kept.columns == stored.columns
        assert kept.join(batch, ["a", "b"], "left_semi").count() == 3000
        share = (kept.count() - 3000) / 97_000
        assert share <= 1.3 * share_kept(3000, sketch.n_maps) + 0.002
    assert build_sketch(batch, ["a"], 8_000) is None and sketch_maps(8_319) == 0 and sketch_maps(8_320) == 1
    assert share_kept(10 * BITMAP_BITS, 1) > 0.99


def test_each_hash_of_a_sketch_has_its_own_maps_and_no_more_than_the_keys_need(spark):
    batch = spark.range(30_000).selectExpr("CAST(id * 11 AS STRING) AS a")
    stored = spark.range(100_000).selectExpr("CAST(id AS STRING) AS a")
    sketch = build_sketch(batch, ["a"], 10 << 20, 30_000)
    assert sketch.n_maps == 16
    for i, maps in enumerate(sketch.by_hash):
        numbers = sorted(r["_map"] for r in maps.collect())
        assert numbers == list(range(i * 16, (i + 1) * 16))
        assert "Generate" not in maps._jdf.queryExecution().optimizedPlan().toString()
    kept = sketch_keys(stored, sketch, ["a"])
    assert kept.join(batch, "a", "left_semi").count() == 9_091
    assert kept.count() - 9_091 <= 1.5 * share_kept(30_000, 16) * 90_909 + 20
    assert build_sketch(batch, ["a"], 20_000, 30_000).n_maps == 2 and build_sketch(batch, ["a"], 10 << 20, 0).n_maps == 1


def test_batches_above_the_bound_use_the_sketch_and_store_the_same(spark, msgs, threshold, workdir, monkeypatch):
    from streamload.plans import batch as module
    used = []
    real = module.sketch_keys

    def counted(existing, sketch, keys):
        out = real(existing, sketch, keys)
        used.append((existing.count(), out.count()))
        return out
    stored = existing_rows_from_events(spark.read.parquet(f"{SF001}/events.parquet"))
    more = spark.range(20_000).selectExpr("concat('x', id) AS event_id", "'2024-01-29' AS audit_load_date")
    for name in ("t", "plain"):
        append_parquet(stored, f"{workdir}/{name}", "audit_load_date")
        append_parquet(more, f"{workdir}/{name}", "audit_load_date")
    process_batch(msgs, 0, event_spec(f"{workdir}/plain", f"{workdir}/plain_e"))
    monkeypatch.setattr(module, "sketch_keys", counted)
    threshold(16_384)
    process_batch(msgs, 0, event_spec(f"{workdir}/t", f"{workdir}/e"))
    assert rows(read_rows(spark, f"{workdir}/t").select("event_id", "audit_load_date")) == rows(
        read_rows(spark, f"{workdir}/plain").select("event_id", "audit_load_date"))
    (before, after), = used  # of the window, what reaches the shuffle
    assert before > 20_000 and after < before / 10


def test_keys_of_other_types_are_not_sketched(spark, msgs, threshold, workdir):
    from streamload.plans.batch import _same_hash
    from pyspark.sql import types as T
    assert _same_hash(T.StringType(), T.StringType()) and _same_hash(T.DecimalType(9, 2), T.DecimalType(9, 2))
    assert not _same_hash(T.IntegerType(), T.LongType()) and not _same_hash(T.DoubleType(), T.DoubleType())


# --------------------------------------------------------------------------- compaction

def files_of(path, day):
    found = []
    for d, _, names in os.walk(path.removeprefix("file:")):
        if f"audit_date={day}" in d:
            found += [n for n in names if n.endswith(".parquet")]
    return found


def test_compaction_changes_no_row_and_bounds_the_files(spark, msgs, workdir):
    path = f"{workdir}/audit"
    day = dt.datetime(2024, 1, 30)

    def load(batch, date, part):
        spec = event_spec(f"{workdir}/t", f"{workdir}/e", audit_path=path, as_of=date)
        process_batch(msgs.filter(f"partition = {part}"), batch, spec, run_id="r")
    for k in range(3):
        load(k, day, k)
    load(3, day + dt.timedelta(days=1), 3)
    reader = read_audit(spark, path)  # planned before the swap, read after it
    before = rows(reader.drop("next_offsets")), rows(latest_offsets(reader))
    assert compact_audit(spark, path, (day + dt.timedelta(days=1)).date()) == 1
    assert (rows(reader.drop("next_offsets")), rows(latest_offsets(reader))) == before
    after = read_audit(spark, path)
    assert (rows(after.drop("next_offsets")), rows(latest_offsets(after))) == before
    load(4, day, 0)  # a late row in a closed day
    assert compact_audit(spark, path, (day + dt.timedelta(days=1)).date()) == 2
    assert len(files_of(path, "2024-01-30")) == 3  # two versions and the late file, which the next run deletes
    assert compact_audit(spark, path, (day + dt.timedelta(days=1)).date()) == 2
    assert len(files_of(path, "2024-01-30")) == 2
    assert current_version(spark, path) == 2
    got = read_audit(spark, path)
    assert got.count() == 5 and rows(latest_offsets(got)) == before[1]
    recent = read_audit(spark, path, "streamload", ["2024-01-30"])
    assert recent.count() == 4
    assert compact_audit(spark, f"{workdir}/none", day.date()) is None


def test_a_compaction_that_stopped_before_its_swap_is_not_seen(spark, msgs, workdir):
    path = f"{workdir}/audit"
    process_batch(msgs, 0, event_spec(f"{workdir}/t", audit_path=path), run_id="r")
    want = rows(latest_offsets(read_audit(spark, path)))
    spark.range(3).write.parquet(f"{path}/_compacted/v1/rows")  # half a version
    assert rows(latest_offsets(read_audit(spark, path))) == want
    assert compact_audit(spark, path, dt.date(2024, 2, 1)) == 2
    assert rows(latest_offsets(read_audit(spark, path))) == want


# --------------------------------------------------------------------------- progress

def test_progress_is_stored_by_batch_and_outlives_the_recorder(spark, msgs, workdir):
    write_replay(msgs, f"{workdir}/replay", files=4)
    table = ProgressTable(spark, f"{workdir}/progress", queries=["stored"])
    spark.streams.addListener(table)
    try:
        def start(name):
            return run_stream(read_replay(spark, f"{workdir}/replay", max_files_per_trigger=1), event_spec(f"{workdir}/{name}"),
                              checkpoint=f"{workdir}/c_{name}", trigger={"availableNow": True}, query_name=name, await_termination=True)
        other = start("other")
        q = start("stored")
        assert table.wait_for(q) and table.wait_for(other)
    finally:
        spark.streams.removeListener(table)
        table.close()
    got = read_progress(spark, f"{workdir}/progress")
    batches = got.filter("event = 'progress' AND num_input_rows > 0")
    assert rows(batches.select("query", "batch_id")) == [("stored", k) for k in range(4)]
    assert batches.agg(F.sum("num_input_rows")).first()[0] == msgs.count()
    assert batches.filter("duration_ms['addBatch'] > 0 AND end_offsets IS NOT NULL").count() == 4
    assert rows(got.groupBy("event").count().filter("event != 'progress'")) == [("started", 1), ("terminated", 1)]
    n = got.count()
    compact_progress(spark, f"{workdir}/progress", dt.date(2999, 1, 1))
    assert read_progress(spark, f"{workdir}/progress").count() == n


def test_a_failed_write_is_told_at_the_end(spark, workdir):
    table = ProgressTable(spark, f"{workdir}/progress")
    table.path = "nosuchfs://x/y"
    table._put("q", "r", "started", dt.datetime.now(dt.timezone.utc), "name")
    with pytest.raises(Exception, match="nosuchfs"):
        table.close()
