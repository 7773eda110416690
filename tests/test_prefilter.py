"""Existing keys cut down by a broadcast semi join on the batch keys before the anti join."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from streamload.operators import anti_join_existing, restrict_to_keys
from streamload.plans.batch import (batch_stats, broadcast_threshold, candidate_keys, error_positions,
                                    good_rows_plan, parse_batch, parse_bytes, process_batch, transform_batch)
from streamload.sinks import append_parquet
from streamload.sources import existing_rows_from_events, messages_from_events
from streamload.sources.feed import event_spec
from streamload.sources.target import read_rows


@pytest.mark.parametrize("text,n", [("10485760", 10485760), ("10485760b", 10485760), ("10MB", 10 << 20),
                                    ("10m", 10 << 20), ("1g", 1 << 30), ("-1", -1), ("512KiB", 512 << 10)])
def test_parse_bytes(text, n):
    assert parse_bytes(text) == n


@pytest.fixture(scope="module")
def msgs(spark):
    return messages_from_events(spark.read.parquet(f"{SF001}/events.parquet")).cache()


def test_restrict_then_anti_join_equals_anti_join(spark):
    conv = spark.read.parquet(f"{SF001}/conversations.parquet")
    stored = conv.filter(F.col("role") == "user").select("conv_id", "turn")
    batch = conv.filter(F.col("turn") <= 3)
    keys = ["conv_id", "turn"]
    plain = anti_join_existing(batch, stored, keys)
    cut = anti_join_existing(batch, restrict_to_keys(stored, batch.select(*keys), keys), keys)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, cut.collect()))
    assert restrict_to_keys(None, batch, keys) is None


def test_stats_bound_and_hooks(spark, msgs):
    spec = event_spec("unused")
    parsed = parse_batch(msgs, spec)
    result = transform_batch(parsed, spec)
    stats = batch_stats(result, spec)
    assert stats.n_in == stats.n_flat == msgs.count()
    assert (stats.n_parse_failure, stats.n_null_key) == (23, 12)
    n_err = error_positions(result).count()
    assert n_err == 23 + 12  # FIXTURES.md §4 at sf0.001: parse failures + null keys
    assert stats.error_bytes >= n_err * (48 + 3 * 8 + len("events"))
    raw_key_bytes = candidate_keys(result, spec).agg(F.sum(F.octet_length("event_id"))).first()[0]
    assert stats.key_bytes >= raw_key_bytes + 48 * candidate_keys(result, spec).count()
    hooked = event_spec("unused", transformer=lambda df: df)
    through = transform_batch(parse_batch(msgs, hooked), hooked)
    assert batch_stats(through, hooked) == stats._replace(n_flat=stats.n_in - stats.n_parse_failure)
    assert error_positions(through).count() == n_err
    bare = event_spec("unused", transformer=lambda df: df.drop("_src"))
    assert error_positions(transform_batch(parse_batch(msgs, bare), bare)) is None


def test_masking_hook_gets_the_semi_join(spark, msgs, workdir):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    append_parquet(existing_rows_from_events(events), f"{workdir}/target", "audit_load_date")
    spec = event_spec(f"{workdir}/target", transformer=lambda df: df.withColumn("event_timestamp", F.lit("x")))
    res = transform_batch(parse_batch(msgs, spec), spec)
    good, _ = good_rows_plan(res.good, spec, spec.as_of, candidates=candidate_keys(res, spec))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Exchange hashpartitioning") < plan.index("LeftSemi")


def test_semi_join_is_in_the_plan_and_scan_not_shuffled(spark, msgs, workdir):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    append_parquet(existing_rows_from_events(events), f"{workdir}/target", "audit_load_date")
    spec = event_spec(f"{workdir}/target")
    parsed = parse_batch(msgs, spec)
    res = transform_batch(parsed, spec)
    good, _ = good_rows_plan(res.good, spec, spec.as_of, candidates=candidate_keys(res, spec))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan
    # the exchanges are the in-batch dedup's and, above the semi join, that of the keys it left
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.rindex("Exchange hashpartitioning") < plan.index("LeftSemi")


def test_same_target_with_and_without_prefilter(spark, msgs, workdir):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    keysets = []
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for i, threshold in enumerate(["10MB", "-1"]):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            if threshold == "-1":
                assert broadcast_threshold(spark) < 0
            root = f"{workdir}/t{i}"
            append_parquet(existing_rows_from_events(events), f"{root}/target", "audit_load_date")
            spec = event_spec(f"{root}/target", f"{root}/errors")
            for batch_id in (0, 1):  # the retry must add nothing to either dataset
                m = process_batch(msgs, batch_id, spec)
            errors = sorted(map(tuple, read_rows(spark, f"{root}/errors").select("kafka_partition", "kafka_offset")
                                .collect()))
            keysets.append((m.n_written, m.n_bad_written, errors,
                            sorted(r[0] for r in read_rows(spark, f"{root}/target").select("event_id").collect())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert keysets[0] == keysets[1]
    assert keysets[0][:2] == (0, 0) and len(keysets[0][2]) == 35


def test_error_branch_semi_join_in_plan(spark, msgs, workdir):
    from streamload.plans.batch import error_rows_plan
    spec = event_spec(f"{workdir}/target", f"{workdir}/errors")
    parsed = parse_batch(msgs, spec)
    res = transform_batch(parsed, spec)
    append_parquet(res.bad, f"{workdir}/errors", "audit_load_date")
    bad, _ = error_rows_plan(res.bad, spec, spec.as_of, error_positions(res))
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "Exchange hashpartitioning" not in plan[plan.index("LeftSemi"):]
    assert bad.count() == 0


def test_clean_batch_skips_the_error_branch(spark, workdir):
    import os
    events = spark.read.parquet(f"{SF001}/events.parquet")
    clean = messages_from_events(events, damage=False, duplicates=False)
    spec = event_spec(f"{workdir}/target", f"{workdir}/errors")
    m = process_batch(clean, 0, spec)
    assert m.n_bad == 0 and m.n_bad_written == 0 and m.n_written == events.count() - m.n_filtered
    local = f"{workdir}/errors"[len("file:"):] if workdir.startswith("file:") else f"{workdir}/errors"
    assert not os.path.exists(local)


def _targets_with_and_without(spark, make_spec, seed_fn):
    out = []
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in ("10MB", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            spec = make_spec(threshold)
            seed_fn(spec)
            m = process_batch(msgs_of(spark), 0, spec)
            out.append((m.n_written, m.n_duplicate_target, spec))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    return out


def msgs_of(spark):
    return messages_from_events(spark.read.parquet(f"{SF001}/events.parquet"))


def test_composite_key_same_result_with_and_without_prefilter(spark, workdir):
    events = spark.read.parquet(f"{SF001}/events.parquet")

    def make(th):
        return event_spec(f"{workdir}/{th}/target", f"{workdir}/{th}/errors", primary_keys=["event_id", "user_id"])

    def seed(spec):
        append_parquet(existing_rows_from_events(events), spec.target.path, "audit_load_date")

    (w1, d1, s1), (w2, d2, s2) = _targets_with_and_without(spark, make, seed)
    assert (w1, d1) == (w2, d2) and d1 > 0
    rows = [sorted(map(tuple, read_rows(spark, s.target.path).select("event_id", "user_id").collect()))
            for s in (s1, s2)]
    assert rows[0] == rows[1]


def test_table_target_same_result_with_and_without_prefilter(spark, workdir):
    import uuid
    from streamload import Target
    from streamload.sinks import append_table, create_target_table
    events = spark.read.parquet(f"{SF001}/events.parquet")
    seed_rows = existing_rows_from_events(events)

    def make(th):
        name = f"prefilter_{uuid.uuid4().hex[:8]}"
        create_target_table(spark, name, seed_rows.schema, "audit_load_date", path=f"{workdir}/{name}")
        return event_spec("unused", f"{workdir}/{name}_errors").with_(target=Target(table=name))

    def seed(spec):
        append_table(seed_rows, spec.target.table)

    (w1, d1, s1), (w2, d2, s2) = _targets_with_and_without(spark, make, seed)
    assert (w1, d1) == (w2, d2) and d1 > 0
    keys = [sorted(r[0] for r in spark.table(s.target.table).select("event_id").collect()) for s in (s1, s2)]
    assert keys[0] == keys[1]
