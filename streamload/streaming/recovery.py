"""Restart from audited offsets (AUD-2, AUD-3, AUD-4).

Use when a query must start without its checkpoint (lost, or a new query
over an existing target): the audit dataset says where each partition of
the topic stopped.  Recovery keeps the target anti join on (``dedup_mode``
"always", or ``reprocess=True``): a crash between the data append and the
audit append replays one batch, and only the anti join makes that safe.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession

from ..functions.columns import resolve_as_of
from ..operators.audit import latest_offsets, read_audit, starting_offsets_json


def starting_offsets_from_audit(spark: SparkSession, audit_path: str | None, topic: str, *, app: str | None = None,
                                partitions: int | None = None, audit_table: str | None = None,
                                ledger_path: str | None = None) -> str | None:
    """``startingOffsets`` JSON for ``topic`` from the audit, or None when nothing is audited.

    ``partitions`` (the topic's partition count) fills partitions never
    audited with ``-2`` (earliest), since Kafka needs every partition
    listed.  One row per partition reaches the driver.

    ``ledger_path`` (of atomic batches) leaves out batches that were never committed.

    Where ``app`` and ``partitions`` are given, the newest dates are read first (a day, a week, a quarter), until every
    partition has been seen; only a partition silent for longer needs the whole dataset.
    """
    audit = None
    if app is not None and partitions is not None:
        today = resolve_as_of(None).date()
        for days in (1, 7, 90):
            dates = [(today - _dt.timedelta(days=k)).isoformat() for k in range(-1, days)]
            recent = read_audit(spark, audit_path, app, dates, table=audit_table, ledger_path=ledger_path)
            if recent is not None and latest_offsets(recent, topic, app).count() >= partitions:
                audit = recent
                break
    audit = audit if audit is not None else read_audit(spark, audit_path, table=audit_table, ledger_path=ledger_path)
    if audit is None:
        return None
    latest = latest_offsets(audit, topic, app)
    if partitions is not None:
        from pyspark.sql import functions as F
        every = spark.range(partitions).select(F.lit(topic).alias("topic"),
                                               F.col("id").cast("int").alias("kafka_partition"))
        latest = every.join(latest, ["topic", "kafka_partition"], "left").select(
            "topic", "kafka_partition", F.coalesce("next_offset", F.lit(-2).cast("long")).alias("next_offset"))
    row = starting_offsets_json(latest).first()
    text = None if row is None else row[0]
    return None if text in (None, "{}") else text
