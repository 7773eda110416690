"""Faults that no result shows: each must raise, or be seen, instead of losing rows or duplicates."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from streamload import FilterRule, PipelineSpec
from streamload.operators import apply_rules
from streamload.operators.audit import latest_offsets, read_audit
from streamload.plans.batch import process_batch, run_batch
from streamload.sinks import append_parquet, append_table, create_target_table
from streamload.sources import messages_from_events
from streamload.sources.feed import event_spec
from streamload.spec import SpecError


@pytest.fixture(scope="module")
def msgs(spark):
    return messages_from_events(spark.read.parquet(f"{SF001}/events.parquet")).cache()


def test_target_without_the_key_column_raises(spark, msgs, workdir):
    rows = spark.createDataFrame([("1", "2024-01-30"), ("2", "2024-01-29")], "key_id string, audit_load_date string")
    append_parquet(rows, f"{workdir}/t", "audit_load_date")
    with pytest.raises(SpecError, match="event_id"):
        process_batch(msgs, 0, event_spec(f"{workdir}/t"))


def test_one_file_without_the_key_column_raises(spark, msgs, workdir):
    append_parquet(spark.createDataFrame([("1", "2024-01-29")], "event_id string, audit_load_date string"),
                   f"{workdir}/t", "audit_load_date")
    append_parquet(spark.createDataFrame([("1", "2024-01-30")], "other string, audit_load_date string"),
                   f"{workdir}/t", "audit_load_date")
    with pytest.raises(Exception, match="stored"):
        process_batch(msgs, 0, event_spec(f"{workdir}/t"))


def test_key_types_that_do_not_compare_raise(spark, msgs, workdir):
    append_parquet(spark.createDataFrame([(1, "2024-01-30")], "event_id int, audit_load_date string"),
                   f"{workdir}/t", "audit_load_date")
    with pytest.raises(SpecError, match="stored as int"):
        process_batch(msgs, 0, event_spec(f"{workdir}/t"))


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("column,bad", [("i", "1_000"), ("i", "3.7"), ("d", "2024-01-29xyz"), ("n", "12345.6"), ("i", "99999999999")])
def test_literals_that_spark_cannot_cast_raise(spark, column, bad, ansi):
    df = spark.range(1).selectExpr("CAST(5 AS INT) AS i", "DATE '2024-01-29' AS d", "CAST(1 AS DECIMAL(5,2)) AS n")
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        for rule in (FilterRule(column, "not_equals", bad), FilterRule(column, "not_in", values=[bad]),
                     FilterRule(column, "equals", bad), FilterRule(column, "in", values=[bad])):
            with pytest.raises(SpecError):
                apply_rules(df, [rule])
        assert apply_rules(df, [FilterRule("i", "equals", " 5 "), FilterRule("n", "not_in", values=["2"])]).count() == 1
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_a_second_run_keeps_the_first_ones_offsets(spark, msgs, workdir):
    spec = event_spec(f"{workdir}/t", audit_path=f"{workdir}/audit")
    run_batch(msgs.filter("partition < 2"), spec)
    run_batch(msgs.filter("partition = 0"), spec)
    got = {r.kafka_partition for r in latest_offsets(read_audit(spark, f"{workdir}/audit"), "events").collect()}
    assert got == {0, 1}
    assert read_audit(spark, f"{workdir}/audit").count() == 2


def test_extra_table_columns_raise(spark, workdir):
    rows = spark.createDataFrame([("a", 1, "2024-01-30")], "k string, v int, d string")
    create_target_table(spark, "streamload_extra", rows.schema, "d", path=f"{workdir}/x")
    try:
        with pytest.raises(ValueError, match="more"):
            append_table(rows.withColumn("more", F.lit(1)), "streamload_extra")
        append_table(rows.withColumn("more", F.lit(1)), "streamload_extra", extra_columns="drop")
        assert spark.table("streamload_extra").count() == 1
    finally:
        spark.sql("DROP TABLE streamload_extra")


def test_unknown_settings_raise():
    base = {"json": {"fields": [{"name": "id"}]}, "primary_keys": ["id"], "output_path": "/t"}
    spec = PipelineSpec.from_dict({**base, "flattener_schema": "variant", "dedup_order": ["id"]})
    assert spec.flattener_schema == "variant" and spec.dedup_order == ("id",)
    with pytest.raises(SpecError, match="lookback_dayz"):
        PipelineSpec.from_dict({**base, "lookback_dayz": 3})


def test_rebuilt_error_rows_are_stored_once(spark, msgs, workdir):
    spec = event_spec(f"{workdir}/t", f"{workdir}/e", reserialize_null_key_rows=True)
    first = process_batch(msgs, 0, spec)
    again = process_batch(msgs, 1, spec)
    assert first.n_bad_written == 35 and again.n_bad_written == 0


def test_corrupt_text_is_not_part_of_the_parsed_struct(spark, msgs):
    from streamload.plans.batch import parse_batch
    assert "_corrupt_record" not in parse_batch(msgs, event_spec("unused")).schema["parsed"].dataType.fieldNames()


def test_audit_into_a_catalog_table(spark, msgs, workdir):
    from streamload.streaming import starting_offsets_from_audit
    spec = event_spec(f"{workdir}/t", audit_table="streamload_audit_test", app_name="a")
    assert starting_offsets_from_audit(spark, None, "events", audit_table=spec.audit_table) is None
    try:
        run_batch(msgs.filter("partition < 2"), spec)
        run_batch(msgs.filter("partition >= 2"), spec)
        text = starting_offsets_from_audit(spark, None, "events", app="a", partitions=4, audit_table=spec.audit_table)
        assert '"-2"' not in text and text.count(":") == 5
        assert read_audit(spark, table=spec.audit_table).count() == 2
    finally:
        spark.sql("DROP TABLE IF EXISTS streamload_audit_test")
