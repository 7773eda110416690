"""

Every query reads the driver's tables (``events``, ``conversations``,
``lineitem``) in full.  Messages are derived from ``events`` by Spark with
the fixed damage rule of ``streamload.sources.feed`` (see FIXTURES.md §4);
each oracle recomputes the expected rows from the *original* columns with
plain SQL, so the check is not circular.  Queries that write (targets,
error paths, replay files, tables) do so under a fresh folder of the
session's shared checkpoint directory.
"""

from __future__ import annotations

import datetime as _dt
import functools
import importlib
import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.errors import StreamingQueryException  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from streamload import FieldMapping, FilterRule, PipelineSpec, Target, mappings_from_groups  # noqa: E402
from streamload.operators import (anti_join_errors, anti_join_existing, apply_rules,  # noqa: E402
                                  batch_offsets, chain, dedup_within_batch, derive_score, error_summary,
                                  existing_keys, flatten, latest_offsets, mask_columns, parse_messages,
                                  project_envelope, starting_offsets_json, threshold_flattener)
from streamload.operators.audit import compact_audit, read_audit  # noqa: E402
from streamload.operators.key_index import build_key_index  # noqa: E402
from streamload.operators.ledger import latest_entries, read_ledger  # noqa: E402
from streamload.operators.quality import IDENTITY  # noqa: E402
from streamload.operators.parse import with_load_date  # noqa: E402
from streamload.functions.columns import resolve_as_of  # noqa: E402
from streamload.plans.batch import (dedup_against_target, parse_batch, process_batch, read_committed,  # noqa: E402
                                   run_batch, run_slices, transform_batch)
from streamload.sinks import append_parquet, append_table, create_target_table  # noqa: E402
from streamload.sources import (existing_rows_from_events, messages_from_events, read_replay,  # noqa: E402
                                read_target, write_replay)
from streamload.sources.feed import EXAMPLE_AS_OF, event_spec  # noqa: E402
from streamload.sources.target import read_rows  # noqa: E402
from streamload.streaming import ProgressRecorder, ProgressTable, read_progress, run_stream  # noqa: E402
from streamload.workspace import fresh_dir  # noqa: E402

AS_OF = _dt.datetime.fromisoformat(EXAMPLE_AS_OF)


# --------------------------------------------------------------------------- helpers

def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _files(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Replay files in proportion to the table: eight for each partition of its scan."""
    return 8 * max(1, _t(spark, sf_dir, name).rdd.getNumPartitions())


def _per_trigger(files: int, of_eight: int) -> int:
    """Files of one micro-batch: of each eight that many, so a backlog is as many micro-batches at any size of the table."""
    return -(-files * of_eight // 8)


def _msgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_events(_t(spark, sf_dir, "events"))


def _seeded(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str]:
    """Fresh folder with a target holding every event before 2024-01-30 (load date = day of ts)."""
    root = fresh_dir(spark, name)
    append_parquet(existing_rows_from_events(_t(spark, sf_dir, "events")), f"{root}/target", "audit_load_date")
    return f"{root}/target", f"{root}/errors"


def _good(spark: SparkSession, sf_dir: str, spec: PipelineSpec | None = None) -> DataFrame:
    spec = spec or event_spec("unused")
    res = transform_batch(parse_batch(_msgs(spark, sf_dir), spec), spec, AS_OF)
    return res.good


def _bad(spark: SparkSession, sf_dir: str, spec: PipelineSpec | None = None) -> DataFrame:
    spec = spec or event_spec("unused")
    return transform_batch(parse_batch(_msgs(spark, sf_dir), spec), spec, AS_OF).bad


def _rule_query(rules: list[FilterRule]) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return apply_rules(_good(spark, sf_dir).drop("_src"), rules)
    return q


# --------------------------------------------------------------------------- queries

def q_ingest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship (PIP-1..3): one batch through parse, split, rules, dedup, write; target read back."""
    target, errors = _seeded(spark, sf_dir, "ingest")
    process_batch(_msgs(spark, sf_dir), 0, event_spec(target, errors))
    return read_rows(spark, target)


def q_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-7: the same batch processed twice leaves the target as once."""
    target, errors = _seeded(spark, sf_dir, "replay")
    spec = event_spec(target, errors)
    process_batch(_msgs(spark, sf_dir), 0, spec)
    process_batch(_msgs(spark, sf_dir), 1, spec)
    return read_rows(spark, target)


def q_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_envelope(_msgs(spark, sf_dir))


def q_parse_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-2/3/5/8/9: explicit field list, parse failures removed, no key split."""
    fields = [FieldMapping("event_id", "event_id"), FieldMapping("event_timestamp", "event_timestamp"),
              FieldMapping("user_id", "actor.user_id", "long"), FieldMapping("event_type", "actor.kind"),
              FieldMapping("value", "measure.value", "double"), FieldMapping("k", "props.k", "int")]
    parsed = parse_messages(_msgs(spark, sf_dir), fields)
    return flatten(parsed.filter(~F.col("parse_failed")), fields)


def q_group_mapping_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-6/7: grouped columns, renames, blank entries, overrides by target name."""
    groups = [{"path": "", "columns": "event_id:id, event_timestamp:at"},
              {"path": "actor", "columns": "user_id : uid, kind"},
              {"path": "measure", "columns": " value:amount , "}]
    spec = PipelineSpec(mappings=mappings_from_groups(groups, [{"name": "uid", "type": "long"},
                                                                {"name": "amount", "type": "double"}]),
                        primary_keys=["id"], target=Target(path="unused"), as_of=AS_OF)
    return _good(spark, sf_dir, spec).drop("_src")


def q_type_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-4/5: short names (any case), DDL types, numbers into strings."""
    fields = [FieldMapping("event_id", "event_id", "String"), FieldMapping("event_ts", "event_timestamp", "timestamp"),
              FieldMapping("uid", "actor.user_id", "INT"), FieldMapping("kind", "actor.kind", "string"),
              FieldMapping("amount", "measure.value", "decimal(10,2)"), FieldMapping("k_text", "props.k", "string")]
    parsed = parse_messages(_msgs(spark, sf_dir), fields)
    return flatten(parsed.filter(~F.col("parse_failed")), fields)


def q_load_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-10: load date in another format and column, fixed per batch; then re-stamped ISO."""
    spec = event_spec("unused", date_format="yyyyMMdd", partition_column="load_day")
    good = _good(spark, sf_dir, spec).select("event_id", "load_day")
    return with_load_date(good, "load_day_iso", "yyyy-MM-dd", AS_OF)


def q_split_parse_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bad(spark, sf_dir).filter(F.col("error_reason") == "JSON_PARSE_FAILURE")


def q_split_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bad(spark, sf_dir).filter(F.col("error_reason") == "NULL_PRIMARY_KEY")


def q_bad_records_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-1 through the hook path (parse failures ∪ null-key rows by name)."""
    spec = event_spec("unused", transformer=lambda df: df)
    return _bad(spark, sf_dir, spec)


def q_split_type_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-3 with on_type_mismatch="error": a mistyped leaf ("n/a" as a double) is a parse failure."""
    return _bad(spark, sf_dir, event_spec("unused", on_type_mismatch="error"))


def q_bad_record_reserialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-12: null-key rows rebuilt as JSON from the flat columns (NULLs left out)."""
    spec = event_spec("unused", reserialize_null_key_rows=True)
    return _bad(spark, sf_dir, spec).filter(F.col("error_reason") == "NULL_PRIMARY_KEY").drop(*IDENTITY)


def q_lookback_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-10 + SRC-4: keys in the 3 load dates ending at as_of (partition discovery: DATE)."""
    target, _ = _seeded(spark, sf_dir, "lookback")
    keys = existing_keys(read_target(spark, target), ["event_id", "audit_load_date"], "audit_load_date", 2, AS_OF)
    return keys.select("event_id", F.col("audit_load_date").cast("string").alias("audit_load_date"))


def q_lookback_keys_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5 + SNK-2 + SNK-6: the same through a catalog table (STRING partition column)."""
    root = fresh_dir(spark, "table")
    name = f"streamload_target_{uuid.uuid4().hex[:10]}"
    rows = existing_rows_from_events(_t(spark, sf_dir, "events"))
    create_target_table(spark, name, rows.schema, "audit_load_date", path=f"{root}/t")
    append_table(rows, name)
    keys = existing_keys(read_target(spark, Target(table=name)), ["event_id", "audit_load_date"],
                         "audit_load_date", 2, AS_OF)
    keys.write.parquet(f"{root}/keys")
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(keys.schema).parquet(f"{root}/keys")


def q_dedup_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, _ = _seeded(spark, sf_dir, "anti")
    spec = event_spec(target)
    good = _good(spark, sf_dir, spec).drop("_src")
    existing = existing_keys(read_target(spark, target), ["event_id"], "audit_load_date", 2, AS_OF)
    return anti_join_existing(good, existing, ["event_id"])


def q_dedup_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-1 on (conv_id, turn); some stored keys are outside the lookback and do not count."""
    conv = _t(spark, sf_dir, "conversations")
    root = fresh_dir(spark, "conv")
    # Every turn is stored; user turns were loaded inside the window, the rest ten days earlier.
    stored = conv.select("conv_id", "turn", F.when(F.col("role") == "user", F.lit("2024-01-30"))
                         .otherwise(F.lit("2024-01-20")).alias("audit_load_date"))
    append_parquet(stored, f"{root}/target", "audit_load_date")
    existing = existing_keys(read_target(spark, f"{root}/target"), ["conv_id", "turn"], "audit_load_date", 2, AS_OF)
    return anti_join_existing(conv, existing, ["conv_id", "turn"])


def q_dedup_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-2 + SRC-6: no target yet -> every row passes."""
    root = fresh_dir(spark, "first")
    existing = existing_keys(read_target(spark, f"{root}/never_written"), ["event_id"], "audit_load_date", 2, AS_OF)
    return anti_join_existing(_good(spark, sf_dir).drop("_src"), existing, ["event_id"])


def q_dedup_within_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-3: one row per key, the earliest (partition, offset) copy."""
    good = _good(spark, sf_dir).withColumn("kafka_offset", F.col("_src.kafka_offset"))
    return dedup_within_batch(good, ["event_id"], ["_src.kafka_partition", "_src.kafka_offset"]).drop("_src")


def q_dedup_within_batch_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-3 on a non-unique composite key with a full tie-break order."""
    li = _t(spark, sf_dir, "lineitem")
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
    return dedup_within_batch(li, ["l_orderkey", "l_linenumber"], order)


def q_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-1/2: counts of one batch, taken from observations on the writes."""
    target, errors = _seeded(spark, sf_dir, "counts")
    m = process_batch(_msgs(spark, sf_dir), 0, event_spec(target, errors))
    names = ["n_in", "n_parse_failure", "n_null_key", "n_filtered", "n_duplicate_in_batch",
             "n_duplicate_target", "n_written", "n_bad_written"]
    return spark.createDataFrame([tuple(getattr(m, n) for n in names)], ", ".join(f"{n} long" for n in names))


def q_error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, errors = _seeded(spark, sf_dir, "errsum")
    process_batch(_msgs(spark, sf_dir), 0, event_spec(target, errors))
    return error_summary(read_rows(spark, errors))


def q_sink_errors_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3 + JN-4: the error batch appended twice is stored once."""
    root = fresh_dir(spark, "errs")
    bad = _bad(spark, sf_dir)
    for _ in range(2):
        stored = read_rows(spark, f"{root}/errors")
        append_parquet(anti_join_errors(bad, stored), f"{root}/errors", "audit_load_date")
    return read_rows(spark, f"{root}/errors")


def q_sink_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1 + SNK-5: rebalanced, file-size-capped append, read back."""
    root = fresh_dir(spark, "pq")
    append_parquet(_good(spark, sf_dir).drop("_src"), f"{root}/t", "audit_load_date", max_records_per_file=1000)
    return read_rows(spark, f"{root}/t")


def q_sink_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2 + PRJ-13: rows in another column order are inserted by name."""
    root = fresh_dir(spark, "tbl")
    name = f"streamload_sink_{uuid.uuid4().hex[:10]}"
    good = _good(spark, sf_dir).drop("_src")
    create_target_table(spark, name, good.schema, "audit_load_date", path=f"{root}/t")
    append_table(good.select(*reversed(good.columns)), name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    return read_rows(spark, f"{root}/t")


def q_batch_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_offsets(parse_batch(_msgs(spark, sf_dir), event_spec("unused")))


def _audited(spark: SparkSession, sf_dir: str) -> str:
    """Two batches (originals, then re-sent copies) with an audit path; returns it."""
    target, errors = _seeded(spark, sf_dir, "audit")
    audit = target.rsplit("/", 1)[0] + "/audit"
    spec = event_spec(target, errors, audit_path=audit, app_name="events_loader")
    msgs = _msgs(spark, sf_dir)
    first = msgs.filter(F.col("offset") % 2 == 0)
    again = msgs.filter(F.col("offset") % 2 == 1)
    process_batch(first, 0, spec)
    process_batch(again, 1, spec)
    return audit


def q_audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUD-1: one audit row per batch and topic with the batch's counts."""
    audit = read_audit(spark, _audited(spark, sf_dir))
    return audit.select("app", "topic", "batch_id", "n_in", "n_bad", "n_filtered", "n_duplicate", "n_written",
                        F.size("next_offsets").alias("n_partitions"))


def q_latest_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-3 + AUD-2: highest audited next offset per partition."""
    return latest_offsets(read_audit(spark, _audited(spark, sf_dir)), "events")


def q_starting_offsets_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUD-3: audited offsets as the Kafka startingOffsets JSON."""
    return starting_offsets_json(latest_offsets(read_audit(spark, _audited(spark, sf_dir)), "events"))


def q_hook_mask_and_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT-1/3/4: masking + derived column through the transformer hook, params given."""
    hook = chain(mask_columns(["event_timestamp"]), derive_score("event_type", "type_score",
                                                                 {"purchase": 3, "signup": 2}))
    spec = event_spec("unused", transformer=hook, params={"mask": "***"})
    return _good(spark, sf_dir, spec).drop("_src")


def q_hook_custom_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT-2/3: custom flattener over the whole document with a threshold parameter."""
    flattener = threshold_flattener({"event_id": ("event_id", "string"), "user_id": ("actor.user_id", "long"),
                                     "value": ("measure.value", "double")}, measure="value")
    doc = ("event_id string, event_timestamp string, actor struct<user_id: long, kind: string>, "
           "measure struct<value: double>, props struct<k: int>")
    spec = event_spec("unused", flattener=flattener, flattener_schema=doc, params={"threshold": "100"},
                      mappings=[])
    return _good(spark, sf_dir, spec).drop("_src")


def q_hook_custom_flatten_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT-2 over the whole document as a VARIANT: no schema declared for the flattener."""
    flattener = threshold_flattener({"event_id": ("event_id", "string"), "user_id": ("actor.user_id", "long"),
                                     "value": ("measure.value", "double")}, measure="value")
    spec = event_spec("unused", flattener=flattener, flattener_schema="variant", params={"threshold": "100"},
                      mappings=[])
    return _good(spark, sf_dir, spec).drop("_src")


def q_stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1..4, STR-6, STR-7: replay files -> availableNow stream of several micro-batches."""
    target, errors = _seeded(spark, sf_dir, "stream")
    root = target.rsplit("/", 1)[0]
    n = _files(spark, sf_dir, "events")
    write_replay(_msgs(spark, sf_dir), f"{root}/replay", files=n)
    rec = ProgressRecorder()
    spark.streams.addListener(rec)
    try:
        q = run_stream(read_replay(spark, f"{root}/replay", max_files_per_trigger=_per_trigger(n, 2)), event_spec(target, errors),
                       checkpoint=f"{root}/checkpoint", trigger={"availableNow": True},
                       on_metrics=rec.add_metrics)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    finally:
        spark.streams.removeListener(rec)
    return read_rows(spark, target)


def q_reprocess_conditional_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUD-4: dedup_mode="reprocess" skips the target anti join for a batch that is not a replay."""
    target, errors = _seeded(spark, sf_dir, "reproc")
    process_batch(_msgs(spark, sf_dir), 0, event_spec(target, errors, dedup_mode="reprocess"), reprocess=False)
    return read_rows(spark, target)


def q_dedup_stored_key_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-1 where the target stores the key in a narrower type than the batch has."""
    root = fresh_dir(spark, "keytype")
    seed = existing_rows_from_events(_t(spark, sf_dir, "events"))
    append_parquet(seed.withColumn("event_id", F.col("event_id").cast("int")), f"{root}/target", "audit_load_date")
    spec = event_spec(f"{root}/target")
    good = _good(spark, sf_dir, spec).drop("_src").withColumn("event_id", F.col("event_id").cast("long"))
    return dedup_against_target(good, spec, AS_OF)


def q_audit_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUD-1, AUD-2: two runs with equal batch ids keep both their offsets."""
    target, errors = _seeded(spark, sf_dir, "tworuns")
    audit = target.rsplit("/", 1)[0] + "/audit"
    spec = event_spec(target, errors, audit_path=audit, app_name="events_loader")
    msgs = _msgs(spark, sf_dir)
    run_batch(msgs.filter("partition < 2"), spec)
    run_batch(msgs.filter("partition >= 2"), spec)
    return latest_offsets(read_audit(spark, audit), "events")


def q_recovery_from_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUD-2..4: a batch whose audit was never written is read again by a new run and stored once."""
    target, errors = _seeded(spark, sf_dir, "recover")
    audit = target.rsplit("/", 1)[0] + "/audit"
    spec = event_spec(target, errors, audit_path=audit, app_name="events_loader", dedup_mode="reprocess")
    msgs = _msgs(spark, sf_dir)
    process_batch(msgs.filter("partition < 2"), 0, spec, run_id="first", reprocess=True)
    process_batch(msgs.filter("partition >= 2"), 1, spec.with_(audit_path=None), run_id="first", reprocess=True)
    done = latest_offsets(read_audit(spark, audit), "events").select(
        F.col("kafka_partition").alias("partition"), "next_offset")
    left = msgs.join(done, "partition", "left").filter("next_offset IS NULL OR offset >= next_offset").drop("next_offset")
    process_batch(left, 0, spec, run_id="second", reprocess=True)
    return read_rows(spark, target)


def q_dedup_within_batch_map_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-3 over rows with a map column, which has no order."""
    good = _good(spark, sf_dir).withColumn("kafka_offset", F.col("_src.kafka_offset")) \
        .withColumn("by_type", F.create_map("event_type", "user_id"))
    one = dedup_within_batch(good, ["event_id"], ["_src.kafka_partition", "_src.kafka_offset"])
    return one.select("event_id", "kafka_offset", "event_type", F.col("by_type")[F.col("event_type")].alias("by_type_user"))


def q_rule_typed_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-1..4 over DATE, DECIMAL and TIMESTAMP columns; Spark casts the literals."""
    at = F.to_timestamp("event_timestamp")
    good = _good(spark, sf_dir).select("event_id", at.cast("date").alias("day"), at.alias("at"),
                                       F.col("value").cast("decimal(12,2)").alias("amount"))
    rules = [FilterRule("day", "not_in", values=["2024-01-05", "2024-1-6"]), FilterRule("amount", "not_equals", "1e1"),
             FilterRule("at", "not_equals", "2024-01-07T00:00:00")]
    return apply_rules(good, rules).select("event_id", "amount")


def q_split_trailing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-3, FLT-8: a second object in one message makes it a parse failure, by struct and by VARIANT."""
    more = F.when(F.col("key").cast("string").cast("long") % 71 == 0, F.lit('{"event_id": "x"}')).otherwise(F.lit(""))
    msgs = _msgs(spark, sf_dir).withColumn("value", F.concat(F.col("value").cast("string"), more).cast("binary"))
    spec = event_spec("unused")
    forms = [parse_batch(msgs, spec), parse_messages(msgs, spec.mappings, variant=True)]
    bad = [p.filter("parse_failed").select("_src.json_raw", "_src.kafka_partition", "_src.kafka_offset",
                                           F.lit(name).alias("form")) for p, name in zip(forms, ("struct", "variant"))]
    return bad[0].unionByName(bad[1])


def q_load_date_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-10, FLT-10: the clock is the session zone's, whatever the pattern, and the lookback finds those rows."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    root = fresh_dir(spark, "zone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        as_of = resolve_as_of("2024-01-30T03:00:00+00:00")
        rows = _t(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("event_id"))
        rows = with_load_date(with_load_date(rows, "load_day", "yyyyMMdd", as_of), "load_text", "yyyy-MM-dd EEE", as_of)
        append_parquet(rows, f"{root}/t", "load_text")
        stored = read_rows(spark, f"{root}/t", "load_text")
        return existing_keys(stored, ["event_id", "load_day", "load_text"], "load_text", 0, as_of, "yyyy-MM-dd EEE")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def q_errors_replay_reserialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-4: rebuilt error rows of a batch that is run twice are stored once."""
    target, errors = _seeded(spark, sf_dir, "rebuilt")
    spec = event_spec(target, errors, reserialize_null_key_rows=True)
    for batch in (0, 1):
        process_batch(_msgs(spark, sf_dir), batch, spec)
    return read_rows(spark, errors).select("json_raw", "kafka_offset", "error_reason", "audit_load_date").distinct() \
        .join(read_rows(spark, errors).groupBy("error_reason").agg(F.count("*").alias("n_stored")), "error_reason")


def q_sink_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4: batches without messages, or without rows that the rules keep, leave the target as it was."""
    target, errors = _seeded(spark, sf_dir, "empty")
    msgs = _msgs(spark, sf_dir)
    spec = event_spec(target, errors)
    process_batch(msgs.filter("false"), 0, spec)
    process_batch(msgs, 1, spec.with_(rules=(FilterRule("event_type", "in", values=[]),)))
    return read_rows(spark, target)


def q_progress_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-6: the recorder's totals over the micro-batches of a stream."""
    target, errors = _seeded(spark, sf_dir, "progress")
    root = target.rsplit("/", 1)[0]
    n = _files(spark, sf_dir, "events")
    write_replay(_msgs(spark, sf_dir), f"{root}/replay", files=n)
    rec = ProgressRecorder()
    run_stream(read_replay(spark, f"{root}/replay", max_files_per_trigger=_per_trigger(n, 2)), event_spec(target, errors),
               checkpoint=f"{root}/checkpoint", trigger={"availableNow": True}, on_metrics=rec.add_metrics,
               await_termination=True)
    names = ["n_in", "n_parse_failure", "n_null_key", "n_filtered", "n_written", "n_bad_written"]
    totals = rec.totals()
    return spark.createDataFrame([tuple(int(totals[n]) for n in names)], ", ".join(f"{n} long" for n in names))


def q_backfill_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP-3: a backfill in offset slices leaves the target as one batch does."""
    target, errors = _seeded(spark, sf_dir, "slices")
    run_slices(_msgs(spark, sf_dir), event_spec(target, errors), 3)
    return read_rows(spark, target)


class _Stop(Exception):
    """What a stopped driver looks like from inside a batch."""


def _stop_at(step: str, batch: int = 1) -> Callable[[str], None]:
    """An ``on_step`` observer that stops the run when the step of that batch has been done and is not yet noted."""
    seen = []

    def on_step(done: str) -> None:
        seen.append(done)
        if done == step and seen.count(step) > batch:
            raise _Stop(step)
    return on_step


def q_restart_same_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUD-4, STR-7: a stream that stops after the append of its second batch, and before its commit, starts again with its
    checkpoint; in each dedup mode, with and without a ledger, every row is stored once."""
    root = fresh_dir(spark, "restart")
    n = _files(spark, sf_dir, "events")
    write_replay(_msgs(spark, sf_dir), f"{root}/replay", files=n)
    out = None
    for mode, ledger in (("reprocess", False), ("reprocess", True), ("always", True)):
        target, errors = _seeded(spark, sf_dir, "restarted")
        base = target.rsplit("/", 1)[0]
        spec = event_spec(target, errors, dedup_mode=mode, ledger_path=f"{base}/ledger" if ledger else None)

        def start(**more):
            run_stream(read_replay(spark, f"{root}/replay", max_files_per_trigger=-(-n // 2)), spec, checkpoint=f"{base}/checkpoint",
                       trigger={"availableNow": True}, await_termination=True, **more)
        try:
            start(reprocess=True, on_step=_stop_at("data"))
            raise RuntimeError("the stream did not stop")
        except StreamingQueryException:
            pass
        start()
        rows = read_rows(spark, target).withColumn("form", F.lit(f"{mode}, {'ledger' if ledger else 'first batch'}"))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_ledger_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUD-4: a batch that stops after each of its steps in turn, and is run again each time: rows, errors, audit and ledger."""
    target, errors = _seeded(spark, sf_dir, "ledger")
    base = target.rsplit("/", 1)[0]
    spec = event_spec(target, errors, dedup_mode="reprocess", ledger_path=f"{base}/ledger", audit_path=f"{base}/audit")
    for step in ("begun", "data", "errors", "audited", None, "audited"):
        try:
            process_batch(_msgs(spark, sf_dir), 0, spec, run_id="run", reprocess=True, on_step=_stop_at(step, 0) if step else None)
        except _Stop:
            pass
    counts = [read_rows(spark, target).select(F.lit("data").alias("kind")), read_rows(spark, errors).select(F.lit("errors").alias("kind")),
              read_audit(spark, f"{base}/audit").select(F.lit("audit").alias("kind")),
              latest_entries(read_ledger(spark, f"{base}/ledger")).select("step").withColumnRenamed("step", "kind")]
    return functools.reduce(lambda a, b: a.unionByName(b), counts).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def q_commit_all_or_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1, SNK-3, AUD-1: what readers see of atomic batches after a stop at each step, and after the batch has run again."""
    target, errors = _seeded(spark, sf_dir, "atomic")
    base = target.rsplit("/", 1)[0]
    spec = event_spec(target, errors, ledger_path=f"{base}/ledger", audit_path=f"{base}/audit", atomic=True)
    msgs = _msgs(spark, sf_dir)
    process_batch(msgs.filter("partition < 2"), 0, spec, run_id="run")
    out = None
    for k, step in enumerate(("begun", "data", "errors", "audited", None)):
        try:
            process_batch(msgs.filter("partition >= 2"), 1, spec, run_id="run", on_step=_stop_at(step, 0) if step else None)
        except _Stop:
            pass
        audit = read_audit(spark, spec.audit_path, ledger_path=spec.ledger_path)
        seen = [read_committed(spark, spec).select("event_id", F.lit("data").alias("kind")),
                read_committed(spark, spec, "errors").select(F.concat_ws(":", "topic", "kafka_partition", "kafka_offset").alias("event_id"),
                                                             F.lit("errors").alias("kind")),
                audit.select(F.concat_ws(":", F.lit("batch"), "batch_id").alias("event_id"), F.lit("audit").alias("kind"))]
        rows = functools.reduce(lambda a, b: a.unionByName(b), seen).withColumn("stopped_at", F.lit(step or "not"))
        # counted and named now: the next attempt goes on in the same folders
        rows = rows.groupBy("stopped_at", "kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_distinct"))
        rows.write.mode("append").parquet(f"{base}/seen")
    return spark.read.parquet(f"{base}/seen")


def q_errors_same_text_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-4: every message without a key arrives twice under one text, at two positions, once in one batch and once in two,
    and all of it again as a replay: two rebuilt rows each, whatever the batches."""
    twice = _msgs(spark, sf_dir)
    twice = twice.unionByName(twice.withColumn("offset", F.col("offset") + 1_000_000_000))
    out = None
    for form, cuts in (("one batch", ["true"]), ("two batches", ["offset < 1000000000", "offset >= 1000000000"])):
        target, errors = _seeded(spark, sf_dir, "twice")
        spec = event_spec(target, errors, reserialize_null_key_rows=True)
        for batch, cut in enumerate([*cuts, "true"]):
            process_batch(twice.filter(cut), batch, spec)
        rows = read_rows(spark, errors).filter("error_reason = 'NULL_PRIMARY_KEY'") \
            .select("json_raw", "kafka_offset", "src_topic", "src_partition", "src_offset", F.lit(form).alias("form"))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_backfill_sliced_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP-3: copies of a key, with another event type, lie in other partitions at far offsets, and some messages have no
    offset; a backfill in slices of the keys leaves the target that one batch leaves."""
    msgs = _msgs(spark, sf_dir)
    copies = msgs.filter("offset % 3 = 0").withColumns({
        "partition": (F.col("partition") + 1) % 4, "offset": F.col("offset") + 7_000_000,
        "value": F.regexp_replace(F.col("value").cast("string"), '"kind": "', '"kind": "copy-').cast("binary")})
    spread = msgs.withColumn("offset", F.when(F.col("offset") % 11 != 5, F.col("offset"))).unionByName(copies)
    target, errors = _seeded(spark, sf_dir, "spread")
    spec = event_spec(target, errors)
    run_slices(spread, spec, 4)
    whole, whole_errors = _seeded(spark, sf_dir, "whole")
    process_batch(spread, 0, spec.with_(target=Target(path=whole), error_path=whole_errors))
    forms = [("sliced", target, errors), ("one batch", whole, whole_errors)]
    out = [read_rows(spark, t).withColumn("form", F.lit(f)) for f, t, _ in forms]
    return out[0].unionByName(out[1])


def q_dedup_key_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-1: the anti join against a bucketed index of the stored keys, which each batch extends; loaded twice."""
    target, errors = _seeded(spark, sf_dir, "indexed")
    base = target.rsplit("/", 1)[0]
    name = f"streamload_keys_{uuid.uuid4().hex[:8]}"
    spec = event_spec(target, errors, key_index=name)
    stored = read_rows(spark, target)
    build_key_index(spark, name, stored, stored.schema, spec.primary_keys, spec.partition_column, buckets=8, path=f"{base}/keys")
    try:
        for batch in (0, 1):
            process_batch(_msgs(spark, sf_dir), batch, spec)
        indexed = spark.read.parquet(f"{base}/keys").groupBy("event_id").agg(F.count(F.lit(1)).alias("n_indexed"))
    finally:
        spark.sql(f"DROP TABLE {name}")
    return read_rows(spark, target).join(indexed, "event_id")


def q_dedup_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-1: with more batch keys than may be broadcast, a Bloom filter of them drops stored keys before the exact join."""
    target, errors = _seeded(spark, sf_dir, "sketch")
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    try:
        spark.conf.set(name, str(max(16_384, 4 * _t(spark, sf_dir, "events").count())))
        for batch in (0, 1):
            process_batch(_msgs(spark, sf_dir), batch, event_spec(target, errors))
    finally:
        spark.conf.set(name, old)
    return read_rows(spark, target)


def q_audit_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUD-1, AUD-2: offsets of an audit whose closed days have been rewritten twice, with batches in between."""
    target, errors = _seeded(spark, sf_dir, "packed")
    audit = target.rsplit("/", 1)[0] + "/audit"
    for day in range(4):
        spec = event_spec(target, errors, audit_path=audit, app_name="events_loader", as_of=AS_OF + _dt.timedelta(days=day))
        for half in (0, 1):
            process_batch(_msgs(spark, sf_dir).filter(f"partition = {day} AND offset % 2 = {half}"), 2 * day + half, spec, run_id="run")
        if day % 2:
            compact_audit(spark, audit, (AS_OF + _dt.timedelta(days=day)).date())
    return latest_offsets(read_audit(spark, audit), "events")


def q_progress_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-6: the listener's events of a stream, as they are stored: messages, batches without a gap, start and end."""
    target, errors = _seeded(spark, sf_dir, "monitored")
    root = target.rsplit("/", 1)[0]
    n = _files(spark, sf_dir, "events")
    write_replay(_msgs(spark, sf_dir), f"{root}/replay", files=n)
    table = ProgressTable(spark, f"{root}/progress", queries=["monitored"])
    spark.streams.addListener(table)
    try:
        q = run_stream(read_replay(spark, f"{root}/replay", max_files_per_trigger=_per_trigger(n, 3)), event_spec(target, errors),
                       checkpoint=f"{root}/checkpoint", trigger={"availableNow": True}, query_name="monitored", await_termination=True)
        table.wait_for(q)
    finally:
        spark.streams.removeListener(table)
        table.close()
    rows = read_progress(spark, f"{root}/progress")
    batches = F.when(F.col("num_input_rows") > 0, F.col("batch_id"))
    return rows.groupBy("query").agg(
        F.sum("num_input_rows").alias("n_in"), (F.max(batches) + 1 == F.countDistinct(batches)).alias("no_gap"),
        F.count_if(F.col("event") == "started").alias("n_started"), F.count_if(F.col("event") == "terminated").alias("n_terminated"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dedup_key_index": q_dedup_key_index,
    "dedup_sketch": q_dedup_sketch,
    "audit_compacted": q_audit_compacted,
    "progress_table": q_progress_table,
    "restart_same_checkpoint": q_restart_same_checkpoint,
    "ledger_resume": q_ledger_resume,
    "commit_all_or_none": q_commit_all_or_none,
    "errors_same_text_two_batches": q_errors_same_text_two_batches,
    "backfill_sliced_spread": q_backfill_sliced_spread,
    "dedup_stored_key_type": q_dedup_stored_key_type,
    "audit_two_runs": q_audit_two_runs,
    "recovery_from_audit": q_recovery_from_audit,
    "dedup_within_batch_map_column": q_dedup_within_batch_map_column,
    "rule_typed_literals": q_rule_typed_literals,
    "split_trailing_text": q_split_trailing_text,
    "load_date_zone": q_load_date_zone,
    "errors_replay_reserialized": q_errors_replay_reserialized,
    "sink_empty": q_sink_empty,
    "progress_totals": q_progress_totals,
    "backfill_sliced": q_backfill_sliced,
    "ingest_batch": q_ingest_batch,
    "replay_idempotent": q_replay_idempotent,
    "stream_available_now": q_stream_available_now,
    "envelope": q_envelope,
    "parse_flatten": q_parse_flatten,
    "group_mapping_rename": q_group_mapping_rename,
    "type_casts": q_type_casts,
    "load_date": q_load_date,
    "split_parse_failures": q_split_parse_failures,
    "split_null_keys": q_split_null_keys,
    "bad_records_union": q_bad_records_union,
    "bad_record_reserialized": q_bad_record_reserialized,
    "split_type_mismatch": q_split_type_mismatch,
    "rule_equals": _rule_query([FilterRule("event_type", "equals", "purchase")]),
    "rule_not_equals": _rule_query([FilterRule("k", "not_equals", "030")]),
    "rule_in": _rule_query([FilterRule("event_type", "in", values=["click", "view"])]),
    "rule_not_in": _rule_query([FilterRule("k", "not_in", values=["1", "2", "3"])]),
    "rule_is_null": _rule_query([FilterRule("value", "is_null")]),
    "rule_is_not_null": _rule_query([FilterRule("value", "is_not_null")]),
    "rules_conjunction": _rule_query([FilterRule("event_type", "IN", values=["purchase", "click", "view"]),
                                      FilterRule("event_type", "Not_Equals", "view"),
                                      FilterRule("value", "is_not_null"),
                                      FilterRule("user_id", "not_equals", "7"),
                                      FilterRule("k", "not_in", values=[])]),
    "lookback_keys": q_lookback_keys,
    "lookback_keys_table": q_lookback_keys_table,
    "dedup_anti_join": q_dedup_anti_join,
    "dedup_composite_key": q_dedup_composite_key,
    "dedup_first_run": q_dedup_first_run,
    "dedup_within_batch": q_dedup_within_batch,
    "dedup_within_batch_composite": q_dedup_within_batch_composite,
    "stage_counts": q_stage_counts,
    "error_summary": q_error_summary,
    "sink_parquet_roundtrip": q_sink_parquet_roundtrip,
    "sink_table_roundtrip": q_sink_table_roundtrip,
    "sink_errors_roundtrip": q_sink_errors_roundtrip,
    "batch_offsets": q_batch_offsets,
    "audit_rows": q_audit_rows,
    "latest_offsets": q_latest_offsets,
    "starting_offsets_json": q_starting_offsets_json,
    "hook_mask_and_derive": q_hook_mask_and_derive,
    "hook_custom_flatten": q_hook_custom_flatten,
    "hook_custom_flatten_variant": q_hook_custom_flatten_variant,
    "reprocess_conditional_dedup": q_reprocess_conditional_dedup,
}


# --------------------------------------------------------------------------- oracles
# The message fixture in SQL: damage per event, the re-sent copies, the text.

_MSGS = """
ev AS (
  SELECT *, CASE WHEN event_id % 97 = 0 THEN 'tomb' WHEN event_id % 89 = 0 THEN 'cut'
                 WHEN event_id % 83 = 0 THEN 'nokey' WHEN event_id % 79 = 0 THEN 'badleaf'
                 ELSE 'ok' END AS dmg
  FROM events
),
copies AS (
  SELECT ev.*, CAST(0 AS BIGINT) AS extra FROM ev
  UNION ALL
  SELECT ev.*, CAST(1 AS BIGINT) AS extra FROM ev WHERE event_id % 73 = 0
),
docs AS (
  SELECT *,
    (CASE WHEN dmg = 'nokey' THEN '{' ELSE '{"event_id": "' || CAST(event_id AS VARCHAR) || '", ' END)
    || '"event_timestamp": "' || CAST(ts AS VARCHAR) || '", "actor": {"user_id": ' || CAST(user_id AS VARCHAR)
    || ', "kind": "' || event_type || '"}, "measure": {"value": '
    || (CASE WHEN dmg = 'badleaf' THEN '"n/a"' ELSE CAST(value AS VARCHAR) END)
    || '}, "props": ' || props || '}' AS doc
  FROM copies
),
env AS (
  SELECT CASE WHEN dmg = 'tomb' THEN NULL WHEN dmg = 'cut' THEN substr(doc, 1, length(doc) - 5) ELSE doc END
           AS json_raw,
         'events' AS topic, CAST(event_id % 4 AS INTEGER) AS kafka_partition,
         2 * CAST(event_id // 4 AS BIGINT) + extra AS kafka_offset, ts AS kafka_timestamp,
         event_id AS eid, ts, user_id AS uid, event_type AS etype, value AS val, props, dmg
  FROM docs
),
flat AS (
  SELECT CASE WHEN dmg = 'nokey' THEN NULL ELSE CAST(eid AS VARCHAR) END AS event_id,
         CAST(ts AS VARCHAR) AS event_timestamp, uid AS user_id, etype AS event_type,
         CASE WHEN dmg = 'badleaf' THEN NULL ELSE val END AS value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         '2024-01-30' AS audit_load_date, topic, kafka_partition, kafka_offset, kafka_timestamp, json_raw, dmg,
         eid, ts
  FROM env
),
good AS (SELECT * FROM flat WHERE dmg IN ('ok', 'badleaf')),
seed AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS event_timestamp, user_id, event_type,
         value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         strftime(ts, '%Y-%m-%d') AS audit_load_date
  FROM events WHERE ts < TIMESTAMP '2024-01-30'
),
window_keys AS (
  SELECT event_id FROM seed WHERE audit_load_date IN ('2024-01-28', '2024-01-29', '2024-01-30')
),
new_rows AS (
  SELECT DISTINCT event_id, event_timestamp, user_id, event_type, value, k, audit_load_date
  FROM good WHERE event_type <> 'error' AND event_id NOT IN (SELECT event_id FROM window_keys)
)"""

G = "event_id, event_timestamp, user_id, event_type, value, k, audit_load_date"
ERR = "json_raw, topic, kafka_partition, kafka_offset, kafka_timestamp"


def _w(body: str) -> str:
    return f"WITH {_MSGS}\n{body}"


_TARGET_AFTER = _w(f"SELECT {G} FROM seed UNION ALL SELECT {G} FROM new_rows")

_OFFSETS = """SELECT 'events' AS topic, kafka_partition, MAX(kafka_offset) + 1 AS next_offset
FROM env GROUP BY kafka_partition"""

#: The event id of every message of the batches 0 (partitions 0 and 1) and 1, as atomic batches publish them.
_PUBLISHED = """
SELECT 'data' AS kind, event_id, CAST(0 AS INTEGER) AS batch FROM seed UNION ALL
SELECT 'data', event_id, CAST(CAST(event_id AS BIGINT) % 4 >= 2 AS INTEGER) FROM new_rows UNION ALL
SELECT 'errors', kafka_partition || ':' || kafka_offset, CAST(kafka_partition >= 2 AS INTEGER) FROM flat WHERE dmg IN ('tomb', 'cut', 'nokey')
UNION ALL SELECT 'audit', 'batch:0', 0 UNION ALL SELECT 'audit', 'batch:1', 1"""

ORACLES: dict[str, str] = {
    "dedup_key_index": _w(f"""SELECT a.*, i.n_indexed FROM (SELECT {G} FROM seed UNION ALL SELECT {G} FROM new_rows) a JOIN (
  SELECT event_id, count(*) AS n_indexed FROM (SELECT DISTINCT event_id, audit_load_date FROM seed UNION ALL SELECT event_id, audit_load_date FROM new_rows)
  GROUP BY event_id) i ON i.event_id = a.event_id"""),
    "dedup_sketch": _TARGET_AFTER,
    "audit_compacted": _w(_OFFSETS),
    "progress_table": _w("SELECT 'monitored' AS query, (SELECT count(*) FROM env) AS n_in, true AS no_gap, 1 AS n_started, 1 AS n_terminated"),
    "restart_same_checkpoint": _w(f"SELECT {G}, form FROM (SELECT {G} FROM seed UNION ALL SELECT {G} FROM new_rows), "
                                  "(SELECT unnest(['reprocess, first batch', 'reprocess, ledger', 'always, ledger']) AS form)"),
    "ledger_resume": _w("SELECT 'data' AS kind, (SELECT count(*) FROM seed) + (SELECT count(*) FROM new_rows) AS n UNION ALL "
                        "SELECT 'errors', count(*) FROM flat WHERE dmg IN ('tomb', 'cut', 'nokey') UNION ALL "
                        "SELECT 'audit', 1 UNION ALL SELECT 'audited', 1"),
    "commit_all_or_none": _w(f"SELECT stopped_at, kind, count(*) AS n, count(DISTINCT event_id) AS n_distinct FROM ({_PUBLISHED}), "
                             "(SELECT unnest(['begun', 'data', 'errors', 'audited', 'not']) AS stopped_at) "
                             "WHERE batch = 0 OR stopped_at = 'not' GROUP BY 1, 2"),
    "errors_same_text_two_batches": _w(
        "SELECT '{\"event_timestamp\":\"' || event_timestamp || '\",\"user_id\":' || CAST(user_id AS VARCHAR) "
        "|| ',\"event_type\":\"' || event_type || '\",\"value\":' || CAST(value AS VARCHAR) "
        "|| ',\"k\":' || CAST(k AS VARCHAR) || '}' AS json_raw, CAST(-1 AS BIGINT) AS kafka_offset, 'events' AS src_topic, "
        "kafka_partition AS src_partition, kafka_offset + shift AS src_offset, form FROM flat, "
        "(SELECT unnest([0, 1000000000]) AS shift), (SELECT unnest(['one batch', 'two batches']) AS form) WHERE dmg = 'nokey'"),
    "backfill_sliced_spread": _w(f"""SELECT {G}, form FROM (
  SELECT {G} FROM seed UNION ALL
  SELECT {G} FROM (
    SELECT {G}, kafka_partition AS p, CASE WHEN kafka_offset % 11 <> 5 THEN kafka_offset END AS o FROM good
    UNION ALL
    SELECT event_id, event_timestamp, user_id, 'copy-' || event_type, value, k, audit_load_date, (kafka_partition + 1) % 4, kafka_offset + 7000000
    FROM good WHERE kafka_offset % 3 = 0)
  WHERE event_type <> 'error' AND event_id NOT IN (SELECT event_id FROM window_keys)
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY p NULLS FIRST, o NULLS FIRST) = 1),
  (SELECT unnest(['sliced', 'one batch']) AS form)"""),
    "dedup_stored_key_type": _w("SELECT CAST(event_id AS BIGINT) AS event_id, event_timestamp, user_id, event_type, value, k, "
                                "audit_load_date FROM good WHERE event_id NOT IN (SELECT event_id FROM window_keys)"),
    "audit_two_runs": _w(_OFFSETS),
    "recovery_from_audit": _TARGET_AFTER,
    "dedup_within_batch_map_column": _w("SELECT event_id, kafka_offset, event_type, user_id AS by_type_user FROM good "
                                        "QUALIFY row_number() OVER (PARTITION BY event_id "
                                        "ORDER BY kafka_partition, kafka_offset) = 1"),
    "rule_typed_literals": _w("SELECT event_id, CAST(value AS DECIMAL(12,2)) AS amount FROM good "
                              "WHERE CAST(ts AS DATE) NOT IN (DATE '2024-01-05', DATE '2024-01-06') "
                              "AND CAST(value AS DECIMAL(12,2)) <> 10 AND ts <> TIMESTAMP '2024-01-07 00:00:00'"),
    "split_trailing_text": _w("""SELECT json_raw || CASE WHEN eid % 71 = 0 THEN '{"event_id": "x"}' ELSE '' END AS json_raw,
  kafka_partition, kafka_offset, form
FROM env, (SELECT unnest(['struct', 'variant']) AS form) WHERE dmg IN ('tomb', 'cut') OR eid % 71 = 0"""),
    "load_date_zone": "SELECT CAST(event_id AS VARCHAR) AS event_id, '20240129' AS load_day, '2024-01-29 Mon' AS load_text "
                      "FROM events",
    "errors_replay_reserialized": _w(
        "SELECT DISTINCT e.json_raw, e.kafka_offset, e.error_reason, '2024-01-30' AS audit_load_date, "
        "count(*) OVER (PARTITION BY e.error_reason) AS n_stored FROM ("
        "SELECT json_raw, kafka_offset, 'JSON_PARSE_FAILURE' AS error_reason FROM flat WHERE dmg IN ('tomb', 'cut') UNION ALL "
        "SELECT '{\"event_timestamp\":\"' || event_timestamp || '\",\"user_id\":' || CAST(user_id AS VARCHAR) "
        "|| ',\"event_type\":\"' || event_type || '\",\"value\":' || CAST(value AS VARCHAR) "
        "|| ',\"k\":' || CAST(k AS VARCHAR) || '}' AS json_raw, CAST(-1 AS BIGINT) AS kafka_offset, "
        "'NULL_PRIMARY_KEY' AS error_reason FROM flat WHERE dmg = 'nokey') e"),
    "sink_empty": _w(f"SELECT {G} FROM seed"),
    "progress_totals": _w("""SELECT (SELECT COUNT(*) FROM env) AS n_in,
  (SELECT COUNT(*) FROM env WHERE dmg IN ('tomb', 'cut')) AS n_parse_failure,
  (SELECT COUNT(*) FROM env WHERE dmg = 'nokey') AS n_null_key,
  (SELECT COUNT(*) FROM good WHERE event_type = 'error') AS n_filtered,
  (SELECT COUNT(*) FROM new_rows) AS n_written,
  (SELECT COUNT(*) FROM env WHERE dmg IN ('tomb', 'cut', 'nokey')) AS n_bad_written"""),
    "backfill_sliced": _TARGET_AFTER,
    "ingest_batch": _TARGET_AFTER,
    "replay_idempotent": _TARGET_AFTER,
    "stream_available_now": _TARGET_AFTER,
    "envelope": _w(f"SELECT {ERR} FROM env"),
    "parse_flatten": _w("SELECT event_id, event_timestamp, user_id, event_type, value, k FROM flat "
                        "WHERE dmg IN ('ok', 'badleaf', 'nokey')"),
    "group_mapping_rename": _w("SELECT event_id AS id, event_timestamp AS at, user_id AS uid, event_type AS kind, "
                               "value AS amount, audit_load_date FROM good"),
    "type_casts": _w("SELECT event_id, CAST(ts AS TIMESTAMP) AS event_ts, CAST(user_id AS INTEGER) AS uid, "
                     "event_type AS kind, CAST(value AS DECIMAL(10,2)) AS amount, CAST(k AS VARCHAR) AS k_text "
                     "FROM flat WHERE dmg IN ('ok', 'badleaf', 'nokey')"),
    "load_date": _w("SELECT event_id, '20240130' AS load_day, '2024-01-30' AS load_day_iso FROM good"),
    "split_parse_failures": _w(f"SELECT {ERR}, 'JSON_PARSE_FAILURE' AS error_reason, audit_load_date "
                               "FROM flat WHERE dmg IN ('tomb', 'cut')"),
    "split_null_keys": _w(f"SELECT {ERR}, 'NULL_PRIMARY_KEY' AS error_reason, audit_load_date "
                          "FROM flat WHERE dmg = 'nokey'"),
    "bad_records_union": _w(f"SELECT {ERR}, CASE WHEN dmg = 'nokey' THEN 'NULL_PRIMARY_KEY' "
                            "ELSE 'JSON_PARSE_FAILURE' END AS error_reason, audit_load_date "
                            "FROM flat WHERE dmg IN ('tomb', 'cut', 'nokey')"),
    "split_type_mismatch": _w(f"SELECT {ERR}, CASE WHEN dmg = 'nokey' THEN 'NULL_PRIMARY_KEY' "
                              "ELSE 'JSON_PARSE_FAILURE' END AS error_reason, audit_load_date "
                              "FROM flat WHERE dmg IN ('tomb', 'cut', 'nokey', 'badleaf')"),
    "bad_record_reserialized": _w(
        "SELECT '{\"event_timestamp\":\"' || event_timestamp || '\",\"user_id\":' || CAST(user_id AS VARCHAR) "
        "|| ',\"event_type\":\"' || event_type || '\",\"value\":' || CAST(value AS VARCHAR) "
        "|| ',\"k\":' || CAST(k AS VARCHAR) || '}' AS json_raw, 'events' AS topic, "
        "CAST(-1 AS INTEGER) AS kafka_partition, CAST(-1 AS BIGINT) AS kafka_offset, "
        "TIMESTAMP '2024-01-30 00:00:00' AS kafka_timestamp, 'NULL_PRIMARY_KEY' AS error_reason, audit_load_date "
        "FROM flat WHERE dmg = 'nokey'"),
    "rule_equals": _w(f"SELECT {G} FROM good WHERE event_type = 'purchase'"),
    "rule_not_equals": _w(f"SELECT {G} FROM good WHERE k <> 30"),
    "rule_in": _w(f"SELECT {G} FROM good WHERE event_type IN ('click', 'view')"),
    "rule_not_in": _w(f"SELECT {G} FROM good WHERE k NOT IN (1, 2, 3)"),
    "rule_is_null": _w(f"SELECT {G} FROM good WHERE value IS NULL"),
    "rule_is_not_null": _w(f"SELECT {G} FROM good WHERE value IS NOT NULL"),
    "rules_conjunction": _w(f"SELECT {G} FROM good WHERE event_type IN ('purchase', 'click', 'view') "
                            "AND event_type <> 'view' AND value IS NOT NULL AND user_id <> 7 AND k IS NOT NULL"),
    "lookback_keys": _w("SELECT event_id, audit_load_date FROM seed "
                        "WHERE audit_load_date IN ('2024-01-28', '2024-01-29', '2024-01-30')"),
    "lookback_keys_table": _w("SELECT event_id, audit_load_date FROM seed "
                              "WHERE audit_load_date IN ('2024-01-28', '2024-01-29', '2024-01-30')"),
    "dedup_anti_join": _w(f"SELECT {G} FROM good WHERE event_id NOT IN (SELECT event_id FROM window_keys)"),
    "dedup_composite_key": """SELECT c.* FROM conversations c WHERE NOT EXISTS (
  SELECT 1 FROM conversations s WHERE s.role = 'user'
    AND s.conv_id = c.conv_id AND s.turn = c.turn)""",
    "dedup_first_run": _w(f"SELECT {G} FROM good"),
    "dedup_within_batch": _w(f"SELECT {G}, kafka_offset FROM good QUALIFY row_number() OVER "
                             "(PARTITION BY event_id ORDER BY kafka_partition, kafka_offset) = 1"),
    "dedup_within_batch_composite": """SELECT * FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
  l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",
    "stage_counts": _w("""SELECT
  (SELECT COUNT(*) FROM env) AS n_in,
  (SELECT COUNT(*) FROM env WHERE dmg IN ('tomb', 'cut')) AS n_parse_failure,
  (SELECT COUNT(*) FROM env WHERE dmg = 'nokey') AS n_null_key,
  (SELECT COUNT(*) FROM good WHERE event_type = 'error') AS n_filtered,
  (SELECT COUNT(*) - COUNT(DISTINCT event_id) FROM good WHERE event_type <> 'error') AS n_duplicate_in_batch,
  (SELECT COUNT(DISTINCT event_id) FROM good WHERE event_type <> 'error') - (SELECT COUNT(*) FROM new_rows)
    AS n_duplicate_target,
  (SELECT COUNT(*) FROM new_rows) AS n_written,
  (SELECT COUNT(*) FROM env WHERE dmg IN ('tomb', 'cut', 'nokey')) AS n_bad_written"""),
    "error_summary": _w("SELECT CASE WHEN dmg = 'nokey' THEN 'NULL_PRIMARY_KEY' ELSE 'JSON_PARSE_FAILURE' END "
                        "AS error_reason, audit_load_date, COUNT(*) AS n_errors FROM flat "
                        "WHERE dmg IN ('tomb', 'cut', 'nokey') GROUP BY 1, 2"),
    "sink_parquet_roundtrip": _w(f"SELECT {G} FROM good"),
    "sink_table_roundtrip": _w(f"SELECT {G} FROM good"),
    "sink_errors_roundtrip": _w(f"SELECT {ERR}, CASE WHEN dmg = 'nokey' THEN 'NULL_PRIMARY_KEY' "
                                "ELSE 'JSON_PARSE_FAILURE' END AS error_reason, audit_load_date "
                                "FROM flat WHERE dmg IN ('tomb', 'cut', 'nokey')"),
    "batch_offsets": _w(_OFFSETS),
    "audit_rows": _w("""SELECT 'events_loader' AS app, 'events' AS topic, CAST(b AS BIGINT) AS batch_id,
  COUNT(*) AS n_in, COUNT(*) FILTER (WHERE dmg IN ('tomb', 'cut', 'nokey')) AS n_bad,
  COUNT(*) FILTER (WHERE dmg IN ('ok', 'badleaf') AND etype = 'error') AS n_filtered,
  COUNT(*) FILTER (WHERE dmg IN ('ok', 'badleaf') AND etype <> 'error') - COUNT(*) FILTER (WHERE written)
    AS n_duplicate,
  COUNT(*) FILTER (WHERE written) AS n_written, CAST(COUNT(DISTINCT kafka_partition) AS INTEGER) AS n_partitions
FROM (SELECT env.*, kafka_offset % 2 AS b,
        kafka_offset % 2 = 0 AND dmg IN ('ok', 'badleaf') AND etype <> 'error'
        AND CAST(eid AS VARCHAR) NOT IN (SELECT event_id FROM window_keys) AS written
      FROM env) x
GROUP BY b"""),
    "latest_offsets": _w(_OFFSETS),
    "starting_offsets_json": _w("""SELECT '{"events":{' || string_agg('"' || CAST(kafka_partition AS VARCHAR) || '":'
  || CAST(next_offset AS VARCHAR), ',' ORDER BY kafka_partition) || '}}' AS starting_offsets
FROM (""" + _OFFSETS + ") o"),
    "hook_mask_and_derive": _w("SELECT event_id, '***' AS event_timestamp, user_id, event_type, value, k, "
                               "CASE WHEN event_type = 'purchase' THEN 3 WHEN event_type = 'signup' THEN 2 ELSE 1 END "
                               "AS type_score, audit_load_date FROM good"),
    "hook_custom_flatten": _w("SELECT event_id, user_id, value, audit_load_date FROM good WHERE value > 100"),
    "hook_custom_flatten_variant": _w("SELECT event_id, user_id, value, audit_load_date FROM good "
                                      "WHERE value > 100"),
    "reprocess_conditional_dedup": _w(f"SELECT {G} FROM seed UNION ALL SELECT DISTINCT {G} FROM good "
                                      "WHERE event_type <> 'error'"),
}


# --------------------------------------------------------------------------- contract

def entry(spark: SparkSession) -> DataFrame:
    return q_ingest_batch(spark, "/root/testdata/sf0.001")


def _optional(module: str):
    """The module, or None where it (or a package above it) is not there; errors inside it are raised."""
    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as e:
        if e.name and (module == e.name or module.startswith(f"{e.name}.")):
            return None
        raise


_training_data = _optional("streamload.llm.queries")
_pipeline = _optional("corpus_pipeline") if _training_data else None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    more = dict(_training_data.QUERIES) if _training_data else {}
    if _pipeline:
        more["pipeline"] = _pipeline.run
    return {**QUERIES, **more}


def oracle_sql() -> dict[str, str]:
    more = dict(_training_data.ORACLE_SQL) if _training_data else {}
    if _pipeline and _pipeline.ORACLE_SQL:
        more["pipeline"] = _pipeline.ORACLE_SQL
    return {**ORACLES, **more}
