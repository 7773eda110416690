import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from streamload import FieldMapping, PipelineSpec, Target, process_batch
from streamload.operators import ContractError, mask_columns
from streamload.plans.batch import parse_batch, transform_batch
from streamload.sinks import append_parquet, create_target_table
from streamload.sources import existing_rows_from_events, messages_from_events, read_target
from streamload.sources.feed import event_spec
from streamload.sources.target import read_rows
from streamload.operators.audit import latest_offsets, starting_offsets_json


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF001}/events.parquet")


@pytest.fixture(scope="module")
def msgs(events):
    return messages_from_events(events).cache()


def seeded(spark, events, root):
    append_parquet(existing_rows_from_events(events), f"{root}/target", "audit_load_date")
    return f"{root}/target", f"{root}/errors"


def keyset(spark, path):
    return sorted(r["event_id"] for r in read_rows(spark, path).select("event_id").collect())


def test_counts_add_up_and_match_fixture(spark, events, msgs, workdir):
    target, errors = seeded(spark, events, workdir)
    m = process_batch(msgs, 0, event_spec(target, errors))
    # FIXTURES.md §4 at sf0.001
    assert (m.n_in, m.n_parse_failure, m.n_null_key) == (1014, 23, 12)
    assert m.n_in == m.n_bad + m.n_filtered + m.n_duplicate + m.n_written
    assert m.n_bad_written == 35 and m.load_date == "2024-01-30"
    errs = read_rows(spark, errors)
    assert errs.filter("kafka_offset < 0").count() == 0  # original envelope kept for null-key rows


def test_replay_changes_nothing(spark, events, msgs, workdir):
    target, errors = seeded(spark, events, workdir)
    spec = event_spec(target, errors)
    process_batch(msgs, 0, spec)
    once = keyset(spark, target)
    n_err = read_rows(spark, errors).count()
    m = process_batch(msgs, 1, spec)
    assert m.n_written == 0 and m.n_bad_written == 0
    assert keyset(spark, target) == once and read_rows(spark, errors).count() == n_err


def test_any_split_of_the_batch_gives_the_same_keys(spark, events, msgs, workdir):
    t1, e1 = seeded(spark, events, workdir + "/one")
    process_batch(msgs, 0, event_spec(t1, e1))
    t2, e2 = seeded(spark, events, workdir + "/three")
    spec = event_spec(t2, e2)
    for i, part in enumerate([F.col("partition") == 0, F.col("partition").isin(1, 2), F.col("partition") == 3]):
        process_batch(msgs.filter(part), i, spec)
    assert keyset(spark, t1) == keyset(spark, t2)


def test_in_batch_duplicates_pass_when_switched_off(spark, events, msgs, workdir):
    target, errors = seeded(spark, events, workdir)
    m = process_batch(msgs, 0, event_spec(target, errors, dedup_within_batch=False))
    rows = read_rows(spark, target).filter("audit_load_date = '2024-01-30'")
    assert rows.count() > rows.select("event_id").distinct().count()  # the reference's behaviour
    assert m.n_duplicate_in_batch == 0


def test_empty_batch_does_nothing(spark, msgs, workdir):
    m = process_batch(msgs.limit(0), 0, event_spec(f"{workdir}/t", f"{workdir}/e"))
    assert m.n_in == 0 and read_target(spark, f"{workdir}/t") is None


def test_reprocess_mode(spark, events, msgs, workdir):
    target, errors = seeded(spark, events, workdir)
    spec = event_spec(target, errors, dedup_mode="reprocess")
    m = process_batch(msgs, 0, spec, reprocess=True)
    assert m.dedup_applied and m.n_duplicate_target > 0


def test_transformer_contract(spark, msgs, workdir):
    spec = event_spec(f"{workdir}/t", transformer=lambda df: df.drop("event_id"))
    with pytest.raises(ContractError, match="which dedup joins on"):
        transform_batch(parse_batch(msgs, spec), spec)
    spec = event_spec(f"{workdir}/t", transformer=lambda df: df.drop("k"))
    with pytest.raises(ContractError, match="which the mapping names"):
        transform_batch(parse_batch(msgs, spec), spec)


def test_transformer_may_add_filter_and_mask(spark, msgs, workdir):
    hook = lambda df, p: mask_columns(["event_timestamp"])(df, p).filter("user_id > 10").withColumn("x", F.lit(1))  # noqa
    spec = event_spec(f"{workdir}/t", f"{workdir}/e", transformer=hook)
    m = process_batch(msgs, 0, spec)
    out = read_rows(spark, f"{workdir}/t")
    assert "x" in out.columns and out.filter("event_timestamp <> '[hidden]'").count() == 0
    assert m.n_hook_removed > 0
    assert m.n_in == m.n_bad + m.n_hook_removed + m.n_filtered + m.n_duplicate + m.n_written


def test_hook_without_envelope_falls_back_to_rebuilt_error_rows(spark, msgs, workdir):
    spec = event_spec(f"{workdir}/t", transformer=lambda df: df.drop("_src"))
    bad = transform_batch(parse_batch(msgs, spec), spec, dt.datetime(2024, 1, 30)).bad
    nk = bad.filter("error_reason = 'NULL_PRIMARY_KEY'").collect()
    assert nk and all(r["kafka_offset"] == -1 and r["json_raw"].startswith('{"event_timestamp"') for r in nk)
    pf = bad.filter("error_reason = 'JSON_PARSE_FAILURE'").collect()
    assert pf and all(r["kafka_offset"] >= 0 for r in pf)


def test_table_target(spark, events, msgs, workdir):
    name = "t_" + workdir.rsplit("-", 1)[-1]
    rows = existing_rows_from_events(events)
    create_target_table(spark, name, rows.schema, "audit_load_date", path=f"{workdir}/tbl")
    from streamload.sinks import append_table
    append_table(rows, name)
    before = spark.table(name).count()
    m = process_batch(msgs, 0, event_spec("x", f"{workdir}/e").with_(target=Target(table=name)))
    assert spark.table(name).count() == before + m.n_written and m.n_duplicate_target > 0


def test_audit_and_offset_recovery(spark, events, msgs, workdir):
    target, errors = seeded(spark, events, workdir)
    spec = event_spec(target, errors, audit_path=f"{workdir}/audit")
    process_batch(msgs.filter("offset < 100"), 0, spec)
    process_batch(msgs.filter("offset >= 100"), 1, spec)
    audit = spark.read.parquet(f"{workdir}/audit")
    assert sorted(r["batch_id"] for r in audit.collect()) == [0, 1]
    latest = {r["kafka_partition"]: r["next_offset"] for r in latest_offsets(audit, "events").collect()}
    expect = {r["partition"]: r["m"] + 1 for r in msgs.groupBy("partition").agg(F.max("offset").alias("m")).collect()}
    assert latest == expect
    js = starting_offsets_json(latest_offsets(audit)).first()[0]
    assert js.startswith('{"events":{"0":')


def test_custom_flattener_owns_columns(spark, msgs, workdir):
    def flat(df, params):
        lim = float(params["threshold"])
        return df.select(F.col("parsed.event_id").alias("event_id"), F.col("parsed.measure.value").alias("v"),
                         "_src").filter(F.col("v") > lim)
    spec = event_spec(f"{workdir}/t", flattener=flat, params={"threshold": "10"}, mappings=[],
                      flattener_schema="event_id string, measure struct<value: double>")
    res = transform_batch(parse_batch(msgs, spec), spec)
    assert res.good.drop("_src").columns == ["event_id", "v", "audit_load_date"]
    assert res.good.filter("v <= 10").count() == 0


def test_reference_parse_rule_can_be_chosen(spark, msgs):
    spec = event_spec("x", strict_json=False)
    bad = transform_batch(parse_batch(msgs, spec), spec).bad
    # truncated text is no longer a parse failure: it ends up as a null-key row or even as good
    assert bad.filter("error_reason = 'JSON_PARSE_FAILURE'").count() < 23


def test_spec_field_list_variant(spark, msgs, workdir):
    ms = [FieldMapping("event_id", "event_id"), FieldMapping("amount", "measure.value", "double")]
    spec = PipelineSpec(mappings=ms, primary_keys=["event_id"], target=Target(path=f"{workdir}/t"),
                        as_of=dt.datetime(2024, 1, 30))
    m = process_batch(msgs, 0, spec)
    assert m.n_written == read_rows(spark, f"{workdir}/t").count() > 0


def test_audit_is_idempotent_and_recovery_json(spark, events, msgs, workdir):
    from streamload.streaming import starting_offsets_from_audit
    target, errors = seeded(spark, events, workdir)
    spec = event_spec(target, errors, audit_path=f"{workdir}/audit")
    assert starting_offsets_from_audit(spark, f"{workdir}/audit", "events") is None
    process_batch(msgs.filter("partition < 2"), 7, spec)
    process_batch(msgs.filter("partition < 2"), 7, spec)  # retried batch
    from streamload.operators.audit import read_audit
    assert read_audit(spark, f"{workdir}/audit").count() == 1
    js = starting_offsets_from_audit(spark, f"{workdir}/audit", "events", partitions=4)
    import json
    got = json.loads(js)["events"]
    assert set(got) == {"0", "1", "2", "3"} and got["2"] == -2 and got["3"] == -2 and got["0"] > 0


def test_counts_survive_an_empty_written_set_with_hooks(spark, events, msgs, workdir):
    target, errors = seeded(spark, events, workdir)
    spec = event_spec(target, errors, transformer=lambda df: df.filter("user_id > 10"))
    first = process_batch(msgs, 0, spec)
    again = process_batch(msgs, 1, spec)  # everything is now a duplicate: AQE prunes the written branch
    assert again.n_written == 0 and again.n_in == first.n_in
    assert (again.n_parse_failure, again.n_null_key, again.n_hook_removed, again.n_filtered) == (
        first.n_parse_failure, first.n_null_key, first.n_hook_removed, first.n_filtered)
    assert again.n_in == again.n_bad + again.n_hook_removed + again.n_filtered + again.n_duplicate
