"""Kafka-shaped Parquet files as a replayable source (tests, backfills).

Rows keep the Kafka source's columns, so the pipeline cannot tell the
difference; ``maxFilesPerTrigger`` plays the role of ``maxOffsetsPerTrigger``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])


def write_replay(msgs: DataFrame, path: str, files: int | None = None) -> None:
    """Store Kafka-shaped rows as Parquet (``files`` = number of files, one per trigger slot)."""
    out = msgs.select(*[f.name for f in KAFKA_SCHEMA.fields])
    out = out.hint("rebalance") if files is None else out.repartition(int(files))
    out.write.mode("append").parquet(path)


def read_replay(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of stored messages, schema fixed (never inferred)."""
    r = spark.readStream.schema(KAFKA_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path)


def read_replay_batch(spark: SparkSession, path: str) -> DataFrame:
    """Bounded read of stored messages (PIP-3)."""
    return spark.read.schema(KAFKA_SCHEMA).parquet(path)
