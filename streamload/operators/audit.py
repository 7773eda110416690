"""Offsets and audit rows (AGG-3, AGG-4, AUD-1 … AUD-3).

Every aggregation here is keyed by (topic, Kafka partition), so its output
is bounded by the number of topic partitions, not by the data; the
``collect_list`` calls gather at most one entry per partition.

The audit dataset is append-only and partitioned by ``(app, audit_date)``.  A
batch is known by its run id and its batch id, since the batch ids of a
query with a new checkpoint start again at 0.  A batch that is run again
adds its rows once more, and the reader keeps the last ones, so writing
never reads the history and nothing is ever overwritten.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_of_lit
from ..spec import Target

AUDIT_SCHEMA = T.StructType([
    T.StructField("app", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("next_offsets", T.MapType(T.IntegerType(), T.LongType())),
    T.StructField("n_in", T.LongType()),
    T.StructField("n_bad", T.LongType()),
    T.StructField("n_filtered", T.LongType()),
    T.StructField("n_duplicate", T.LongType()),
    T.StructField("n_written", T.LongType()),
    T.StructField("recorded_at", T.TimestampType()),
    T.StructField("audit_date", T.StringType()),
])


# Folder levels of the audit dataset.
AUDIT_PARTITIONS = ("app", "audit_date")


def append_audit(rows: DataFrame, path: str | None = None, *, table: str | None = None) -> None:
    """Store one batch's audit rows (AUD-1): one file in the folder of its app and date, of a path or a catalog table."""
    w = (rows.select(*[f.name for f in AUDIT_SCHEMA.fields]).hint("rebalance", 1)
         .write.mode("append").format("parquet").partitionBy(*AUDIT_PARTITIONS))
    if table is not None:
        w.saveAsTable(table)
    else:
        w.save(path)


def read_audit(spark: SparkSession, path: str | None = None, app: str | None = None, dates=None, *,
               table: str | None = None, ledger_path: str | None = None) -> DataFrame | None:
    """The audit rows, or ``None`` before the first batch: of each (app, run, batch, topic) the last recorded.

    With ``app`` and ``dates`` only those folders are listed and read.  ``ledger_path`` leaves out batches that have
    begun and are not committed; the ledger is read after the audit, so it names every batch that the audit has.
    """
    from ..sinks.compaction import dataset_folders
    from ..sources.target import read_target
    if table is not None:
        df = read_target(spark, Target(table=table))
        if df is not None and app is not None and dates is not None:
            df = df.filter((F.col("app") == app) & F.col("audit_date").isin(list(dates)))
        found = [df]
    else:
        found = [_read_folder(spark, folder, app, dates) for folder in dataset_folders(spark, path)]
    found = [df for df in found if df is not None]
    if not found:
        return None
    df = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    if ledger_path is not None:
        from .ledger import AUDITED, latest_entries, read_ledger
        ledger = read_ledger(spark, ledger_path)
        if ledger is not None:
            open_batches = latest_entries(ledger).filter(F.col("step") != AUDITED).select("app", "run_id", "batch_id")
            df = df.join(open_batches, ["app", "run_id", "batch_id"], "left_anti")
    keys = ("app", "topic", "run_id", "batch_id")
    rest = [f.name for f in AUDIT_SCHEMA.fields if f.name not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("recorded_at", "n_in", "n_written")).alias("last"))
    return last.select(*[F.col(f.name) if f.name in keys else F.col(f"last.{f.name}").alias(f.name)
                         for f in AUDIT_SCHEMA.fields])


def _read_folder(spark: SparkSession, path: str, app: str | None, dates) -> DataFrame | None:
    from ..sources.target import escape_partition_value, read_partitions, read_target
    if app is None or dates is None:
        return read_target(spark, path, schema=AUDIT_SCHEMA)
    schema = T.StructType([f for f in AUDIT_SCHEMA.fields if f.name != "app"])
    df = read_partitions(spark, f"{path.rstrip('/')}/app={escape_partition_value(app)}", "audit_date", dates, schema=schema)
    return None if df is None else df.withColumn("app", F.lit(app))


def compact_audit(spark: SparkSession, path: str, before: _dt.date) -> int | None:
    """Rewrite the audit of the days before ``before`` to one file per app and day (a file per batch until then)."""
    from ..sinks.compaction import compact
    return compact(spark, path, AUDIT_SCHEMA, AUDIT_PARTITIONS, F.col("audit_date") < before.isoformat())


def _envelope_cols(df: DataFrame) -> tuple[str, str, str]:
    if "_src" in df.columns:
        return "_src.topic", "_src.kafka_partition", "_src.kafka_offset"
    if "kafka_offset" in df.columns:
        return "topic", "kafka_partition", "kafka_offset"
    return "topic", "partition", "offset"


def batch_offsets(df: DataFrame) -> DataFrame:
    """Next offset (max + 1) per (topic, partition) of one batch (AGG-4)."""
    t, p, o = _envelope_cols(df)
    return df.groupBy(F.col(t).alias("topic"), F.col(p).cast("int").alias("kafka_partition")).agg(
        (F.max(F.col(o)) + 1).cast("long").alias("next_offset"))


def offsets_map(offsets: DataFrame) -> DataFrame:
    """``(topic, kafka_partition, next_offset)`` rows -> one row per topic with a map."""
    return offsets.groupBy("topic").agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("kafka_partition", "next_offset")))).alias("next_offsets"))


def audit_rows(offsets: DataFrame, metrics: Mapping[str, int], *, app: str, batch_id: int,
               recorded_at: _dt.datetime, run_id: str = "") -> DataFrame:
    """One audit row per topic of the batch (AUD-1): offsets + stage counts."""
    m = offsets_map(offsets)
    return m.select(
        F.lit(app).alias("app"), F.col("topic"), F.lit(run_id).alias("run_id"),
        F.lit(int(batch_id)).cast("long").alias("batch_id"),
        F.col("next_offsets"),
        *[F.lit(int(metrics.get(k, 0))).cast("long").alias(k)
          for k in ("n_in", "n_bad", "n_filtered", "n_duplicate", "n_written")],
        as_of_lit(recorded_at).cast("timestamp").alias("recorded_at"),
        F.lit(recorded_at.date().isoformat()).alias("audit_date"),
    )


def latest_offsets(audit: DataFrame, topic: str | None = None, app: str | None = None) -> DataFrame:
    """Highest audited next offset per (topic, partition) (AGG-3, AUD-2)."""
    if topic is not None:
        audit = audit.filter(F.col("topic") == topic)
    if app is not None:
        audit = audit.filter(F.col("app") == app)
    return audit.select("topic", F.explode("next_offsets").alias("kafka_partition", "next_offset")).groupBy(
        "topic", "kafka_partition").agg(F.max("next_offset").alias("next_offset"))


def starting_offsets_json(latest: DataFrame) -> DataFrame:
    """``{"topic":{"0":12,"1":7}}`` for the Kafka ``startingOffsets`` option (AUD-3).

    One row, one column ``starting_offsets``.  Must list every partition of
    the topic; it is only used when the query has no checkpoint yet.
    """
    # Sorted by partition number, then topic, so the text is deterministic.
    entries = F.array_sort(F.collect_list(F.struct("kafka_partition", "next_offset")))
    as_text = F.transform(entries, lambda e: F.struct(e["kafka_partition"].cast("string").alias("k"),
                                                      e["next_offset"].alias("v")))
    per_topic = latest.groupBy("topic").agg(F.map_from_entries(as_text).alias("offsets"))
    by_topic = F.array_sort(F.collect_list(F.struct("topic", "offsets")), lambda a, b: F.when(
        a["topic"] < b["topic"], -1).when(a["topic"] > b["topic"], 1).otherwise(0))
    return per_topic.agg(F.to_json(F.map_from_entries(by_topic)).alias("starting_offsets"))
