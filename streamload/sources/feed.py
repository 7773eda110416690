"""Kafka-shaped messages derived from the ``events`` table.

No broker is needed to exercise the pipeline: ``messages_from_events`` turns
each event row into a message with the same columns as Spark's Kafka source
(``key value topic partition offset timestamp timestampType``).  A fixed
rule on ``event_id`` damages some messages so every error path is hit; the
rule is stated here and in FIXTURES.md, and the oracles recompute expected
rows from the original columns with it.

Pure projection + one union: map-side only, no shuffle, scales with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Damage rule of the message fixture (first match wins).
TOMBSTONE_MOD = 97        # value is NULL            -> JSON_PARSE_FAILURE
TRUNCATE_MOD = 89         # last 5 characters cut    -> JSON_PARSE_FAILURE
DROP_KEY_MOD = 83         # event_id left out        -> NULL_PRIMARY_KEY
BAD_LEAF_MOD = 79         # measure.value is "n/a"   -> good, value NULL
DUPLICATE_MOD = 73        # message sent twice: offsets 2 * (event_id // PARTITIONS) and the next one
TRUNCATE_CHARS = 5
PARTITIONS = 4
TOPIC = "events"

# The field mapping of the event document.
EVENT_GROUPS = [
    {"path": "", "columns": "event_id, event_timestamp"},
    {"path": "actor", "columns": "user_id, kind:event_type"},
    {"path": "measure", "columns": "value"},
    {"path": "props", "columns": "k"},
]
EVENT_TYPES = {"user_id": "long", "value": "double", "k": "int"}


def event_document(drop_key: Column | None = None, bad_leaf: Column | None = None) -> Column:
    """JSON text of one event, by string concatenation (reproducible in SQL)."""
    eid = F.col("event_id").cast("string")
    ts = F.col("ts").cast("string")
    head = F.concat(F.lit('{"event_id": "'), eid, F.lit('", '))
    if drop_key is not None:
        head = F.when(drop_key, F.lit("{")).otherwise(head)
    val = F.col("value").cast("string")
    if bad_leaf is not None:
        val = F.when(bad_leaf, F.lit('"n/a"')).otherwise(val)
    return F.concat(
        head,
        F.lit('"event_timestamp": "'), ts,
        F.lit('", "actor": {"user_id": '), F.col("user_id").cast("string"),
        F.lit(', "kind": "'), F.col("event_type"),
        F.lit('"}, "measure": {"value": '), val,
        F.lit('}, "props": '), F.col("props"),
        F.lit("}"),
    )


def messages_from_events(events: DataFrame, damage: bool = True, duplicates: bool = True) -> DataFrame:
    """Kafka-source-shaped rows made from ``events`` (see module docstring).

    The re-sent copies come from one ``explode`` over a per-row list of
    offset shifts, so the table is scanned once.
    """
    eid = F.col("event_id")
    first = [] if not damage else [
        (eid % TOMBSTONE_MOD == 0, "tomb"),
        (eid % TRUNCATE_MOD == 0, "cut"),
        (eid % DROP_KEY_MOD == 0, "nokey"),
        (eid % BAD_LEAF_MOD == 0, "badleaf"),
    ]
    kind = F.lit("ok")
    for cond, name in reversed(first):
        kind = F.when(cond, F.lit(name)).otherwise(kind)
    shifts = F.array(F.lit(0).cast("long"))
    if duplicates:
        shifts = F.when(eid % DUPLICATE_MOD == 0, F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))
                        ).otherwise(shifts)
    base = events.select("event_id", "ts", "user_id", "event_type", "value", "props",
                         kind.alias("_damage"), F.explode(shifts).alias("_shift"))
    doc = event_document(drop_key=F.col("_damage") == "nokey", bad_leaf=F.col("_damage") == "badleaf")
    body = (F.when(F.col("_damage") == "tomb", F.lit(None).cast("string"))
            .when(F.col("_damage") == "cut", F.expr(f"substring(_doc, 1, length(_doc) - {TRUNCATE_CHARS})"))
            .otherwise(F.col("_doc")))
    return base.withColumn("_doc", doc).select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("event_id") % PARTITIONS).cast("int").alias("partition"),
        (2 * F.floor(F.col("event_id") / PARTITIONS).cast("long") + F.col("_shift")).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def existing_rows_from_events(events: DataFrame, loaded_before: str = "2024-01-30", fmt: str = "yyyy-MM-dd",
                              partition_column: str = "audit_load_date") -> DataFrame:
    """Rows already in the target: what earlier loads stored.

    Every event with ``ts`` before ``loaded_before``, flattened like the
    pipeline would, loaded on the date of its ``ts``.  With the example
    clock and a 2-day lookback, the rows loaded on the two days before the
    batch are inside the dedup window; older ones are outside it and are
    loaded again, which is what a lookback on load dates means.
    """
    return events.filter(F.col("ts") < F.lit(loaded_before).cast("timestamp_ntz")).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("string").alias("event_timestamp"),
        F.col("user_id").cast("long").alias("user_id"),
        F.col("event_type").alias("event_type"),
        F.col("value").cast("double").alias("value"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.date_format(F.col("ts"), fmt).alias(partition_column),
    )


# The as-of clock and lookback of the example target.
EXAMPLE_AS_OF = "2024-01-30"
EXAMPLE_LOOKBACK_DAYS = 2


def event_spec(target_path: str, error_path: str | None = None, **changes):
    """The example ingestion spec over the event document (flagship query)."""
    import datetime as _dt

    from ..spec import FilterRule, PipelineSpec, Target, mappings_from_groups
    kw = dict(
        mappings=mappings_from_groups(EVENT_GROUPS, EVENT_TYPES),
        primary_keys=["event_id"],
        target=Target(path=target_path),
        topic=TOPIC,
        error_path=error_path,
        rules=[FilterRule("event_type", "not_equals", "error")],
        lookback_days=EXAMPLE_LOOKBACK_DAYS,
        as_of=_dt.datetime.fromisoformat(EXAMPLE_AS_OF),
    )
    kw.update(changes)
    return PipelineSpec(**kw)
