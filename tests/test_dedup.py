import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from streamload.operators import anti_join_errors, anti_join_existing, dedup_within_batch, existing_keys
from streamload.sinks import append_parquet
from streamload.sources import read_target
from streamload.sources.target import escape_partition_value, read_partitions

AS_OF = dt.datetime(2024, 1, 30)


def test_dedup_within_batch_keeps_earliest_copy(spark):
    df = spark.createDataFrame([("k1", 0, 5, "late"), ("k1", 0, 2, "early"), ("k1", 1, 0, "other-part"),
                                ("k2", 3, 9, "only")], "k string, p int, o long, v string")
    got = {r["k"]: r["v"] for r in dedup_within_batch(df, ["k"], ["p", "o"]).collect()}
    assert got == {"k1": "early", "k2": "only"}
    assert dedup_within_batch(df, ["k"], ["p", "o"]).columns == df.columns


def test_hot_key_is_combined_before_the_shuffle(spark):
    # one key holds a third of all rows
    df = spark.range(30_000).select((F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))).alias("k"),
                                    F.col("id").alias("o"))
    out = dedup_within_batch(df, ["k"], ["o"])
    assert out.count() == 20_001
    assert out.filter("k = -1").first()["o"] == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    # each map task keeps one row of a key before the exchange
    assert "WindowGroupLimit" in plan and "Partial" in plan.split("WindowGroupLimit", 2)[-1]
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_composite_key_with_full_tie_break(spark):
    df = spark.createDataFrame([(1, 1, "b"), (1, 1, "a"), (1, 2, "c"), (1, 1, "a")], "x int, y int, v string")
    assert sorted(tuple(r) for r in dedup_within_batch(df, ["x", "y"], ["v"]).collect()) == [(1, 1, "a"), (1, 2, "c")]


@pytest.mark.parametrize("fmt,values", [
    ("yyyy-MM-dd", ["2024-01-27", "2024-01-28", "2024-01-30", "2024-01-31"]),
    ("yyyyMMdd", ["20240127", "20240128", "20240130", "20240131"]),
])
def test_lookback_window_any_format(spark, workdir, fmt, values):
    rows = [(f"k{i}", v) for i, v in enumerate(values)]
    append_parquet(spark.createDataFrame(rows, "k string, d string"), f"{workdir}/t", "d")
    t = read_target(spark, f"{workdir}/t")  # partition discovery: DATE or INT
    got = sorted(r["k"] for r in existing_keys(t, ["k"], "d", 2, AS_OF, fmt).collect())
    assert got == ["k1", "k2"]
    assert sorted(r["k"] for r in existing_keys(t, ["k"]).collect()) == ["k0", "k1", "k2", "k3"]
    plan = existing_keys(t, ["k"], "d", 2, AS_OF, fmt)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan or "PartitionFilters: [d" in plan


def test_anti_join(spark):
    batch = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k1 string, k2 int, v string")
    existing = spark.createDataFrame([("a", 1), ("c", 9)], "k1 string, k2 int")
    assert sorted(r["v"] for r in anti_join_existing(batch, existing, ["k1", "k2"]).collect()) == ["y", "z"]
    assert anti_join_existing(batch, None, ["k1"]) is batch


def test_missing_target_means_first_run_but_other_errors_raise(spark, workdir):
    assert read_target(spark, f"{workdir}/never") is None
    assert existing_keys(None, ["k"]) is None
    append_parquet(spark.createDataFrame([("a", "2024-01-30")], "k string, d string"), f"{workdir}/t", "d")
    with pytest.raises(AnalysisException):
        existing_keys(read_target(spark, f"{workdir}/t"), ["no_such_key"], "d", 2, AS_OF)


def test_read_partitions_lists_only_the_window(spark, workdir):
    rows = [("a", "2024-01-20"), ("b", "2024-01-29"), ("c", "2024-01-30")]
    append_parquet(spark.createDataFrame(rows, "k string, d string"), f"{workdir}/t", "d")
    df = read_partitions(spark, f"{workdir}/t", "d", ["2024-01-30", "2024-01-29", "2024-01-28"])
    assert sorted(r["k"] for r in df.collect()) == ["b", "c"]
    assert read_partitions(spark, f"{workdir}/t", "d", ["1999-01-01"]) is None
    assert escape_partition_value("2024/01:30") == "2024%2F01%3A30"


def test_error_rows_idempotent(spark):
    errs = spark.createDataFrame([("t", 0, 5), ("t", 0, 6), ("t", -1, -1)],
                                 "topic string, kafka_partition int, kafka_offset long")
    stored = spark.createDataFrame([("t", 0, 5), ("t", -1, -1)], "topic string, kafka_partition int, kafka_offset long")
    got = sorted(r["kafka_offset"] for r in anti_join_errors(errs, stored).collect())
    assert got == [-1, 6]  # rebuilt rows (offset -1) are never matched


def test_error_anti_join_keeps_rebuilt_rows_out_of_the_join(spark):
    from streamload.operators import anti_join_errors
    rows = [("t", -1, -1, f"rebuilt{i}") for i in range(300)] + [("t", 0, i, f"m{i}") for i in range(200)]
    errors = spark.createDataFrame(rows, "topic string, kafka_partition int, kafka_offset long, json_raw string")
    stored = errors.filter("kafka_offset >= 0 AND kafka_offset < 50").unionByName(errors.limit(0))
    out = anti_join_errors(errors, stored)
    got = sorted(r["json_raw"] for r in out.collect())
    assert got == sorted([f"rebuilt{i}" for i in range(300)] + [f"m{i}" for i in range(50, 200)])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # the join input carries only positioned rows
    assert "Union" in plan and "LeftAnti" in plan


def test_anti_join_with_columns_named_like_the_renamed_keys(spark):
    from streamload.operators import restrict_to_keys
    df = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, _k0 string, _c0 int")
    existing = spark.createDataFrame([(2, "x", 9)], "id int, _k0 string, _c0 int")
    assert [r["id"] for r in anti_join_existing(df, existing, ["id"]).collect()] == [1]
    assert [r["id"] for r in restrict_to_keys(existing, df, ["id"]).collect()] == [2]
