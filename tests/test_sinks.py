"""File sizing before writes: when a rebalance is added and when it is not."""

from pyspark.sql import functions as F

from conftest import SF001
from streamload.operators import dedup_within_batch
from streamload.plans.batch import good_rows_plan, parse_batch, transform_batch
from streamload.sinks.files import size_files
from streamload.sources import messages_from_events
from streamload.sources.feed import event_spec


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rebalance_default_none_and_fixed(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    assert "RebalancePartitions" in _plan(size_files(df))
    assert "RebalancePartitions" not in _plan(size_files(df, rebalance=False))
    # a fixed file count is an explicit request: it always rebalances
    assert "RebalancePartitions" in _plan(size_files(df, 3, rebalance=False))


def test_good_rows_end_in_one_shuffle_by_key(spark):
    """With in-batch dedup the good rows already come out of the dedup exchange
    (hash-partitioned by key); the write adds no second exchange."""
    spec = event_spec("unused")
    msgs = messages_from_events(spark.read.parquet(f"{SF001}/events.parquet"))
    res = transform_batch(parse_batch(msgs, spec), spec)
    good, _ = good_rows_plan(res.good, spec, spec.as_of, dedup=False)
    physical = good._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning(event_id") == 1
    assert "RoundRobinPartitioning" not in physical and "REBALANCE" not in physical


def test_dedup_without_rebalance_keeps_every_key(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    out = dedup_within_batch(li, ["l_orderkey", "l_linenumber"], ["l_partkey"])
    assert out.count() == li.select("l_orderkey", "l_linenumber").distinct().count()
