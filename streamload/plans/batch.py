"""One batch, end to end (PIP-1 … PIP-3, AGG-1, AGG-2, AUD-1, AUD-4).

Shape of a non-empty batch::

    raw ──isEmpty?──► envelope+parse ──persist──┬─► flatten/hooks ► load date ► tag
                                                 │        ├─ good ► rules ► in-batch dedup ► anti join ► WRITE good
                                                 │        └─ bad  ───────────────────────► anti join ► WRITE errors
                                                 └─► (audit) offsets per partition ─────────────────► WRITE audit

A ledger (``ledger_path``) notes each of these steps, and a batch that runs again
leaves out those that are done (:mod:`streamload.operators.ledger`).

Two write jobs (plus the audit write when configured) after one job that
fills the persisted batch.  That first job also answers "is the batch
empty?" and measures an upper bound of the batch keys' size, which decides
whether the existing keys are first cut down by a broadcast semi join
against the batch keys (see :func:`batch_stats`).  The parsed batch is
persisted once, so the source is read and the JSON parsed once, however
many writes follow.  That job counts the stages up to the rules as well; what
the writes leave and write is counted by ``Observation``s on their plans.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from typing import Any, NamedTuple

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import any_null, ident, load_date, lookback_values, quote_path, resolve_as_of
from ..operators.audit import append_audit, audit_rows, batch_offsets
from ..operators.dedup import (ERROR_KEYS, anti_join_errors, anti_join_existing, check_key_types,
                               dedup_within_batch, existing_keys, free_prefix, restrict_to_keys)
from ..operators.hooks import apply_flattener, apply_transformer
from ..operators.key_index import append_keys, indexed_keys
from ..operators.ledger import ATTEMPT, AUDITED, BEGUN, DATA, ERRORS, BatchLog, committed_attempts, committed_rows
from ..operators.parse import (ENVELOPE, PARSE_FAILED, SOURCE_STRUCT, flatten_columns, flattener_input,
                               parse_messages, project_envelope)
from ..operators.quality import ERROR_REASON, IDENTITY, error_reason, split_bad_records, to_error_rows
from ..operators.rules import apply_rules, rules_condition
from ..operators.sketch import MAX_KEPT, KeySketch, build_sketch, share_kept, sketch_keys, sketch_maps
from ..sinks.files import append_parquet, append_table
from ..sources.target import read_rows, read_stored, read_target
from ..spec import JSON_PARSE_FAILURE, NULL_PRIMARY_KEY, PipelineSpec
from ..workspace import fresh_dir


@dataclass
class BatchResult:
    """Lazy outputs of :func:`transform_batch` (nothing has run yet)."""

    good: DataFrame
    bad: DataFrame
    observations: dict[str, Observation] = field(default_factory=dict)
    tagged: DataFrame | None = None   # flat rows with error_reason, before the split
    parsed: DataFrame | None = None   # parsed messages (hook path only)
    cached: DataFrame | None = None   # what holds the batch's rows with their positions, persisted or not


@dataclass
class BatchMetrics:
    """Counts of one batch (AGG-1).  ``n_in = n_bad + n_filtered + n_duplicate + n_written``
    holds when no hook removes rows (``n_hook_removed`` counts those)."""

    batch_id: int
    n_in: int = 0
    n_parse_failure: int = 0
    n_null_key: int = 0
    n_hook_removed: int = 0
    n_filtered: int = 0
    n_duplicate_in_batch: int = 0
    n_duplicate_target: int = 0
    n_written: int = 0
    n_bad_written: int = 0
    load_date: str | None = None
    as_of: _dt.datetime | None = None
    dedup_applied: bool = True
    resumed_from: str | None = None  # the step that an earlier attempt at the batch had reached
    seconds: float = 0.0

    @property
    def n_bad(self) -> int:
        return self.n_parse_failure + self.n_null_key

    @property
    def n_duplicate(self) -> int:
        return self.n_duplicate_in_batch + self.n_duplicate_target

    def as_dict(self) -> dict[str, Any]:
        d = asdict(self)
        d.update(n_bad=self.n_bad, n_duplicate=self.n_duplicate)
        return d


def _obs(name: str) -> Observation:
    return Observation(f"{name}_{uuid.uuid4().hex[:12]}")


def observed(o: Observation, key: str) -> int | None:
    """Value of an observed count, or None when the observation never fired.

    When AQE proves a branch empty at run time it replaces the branch, the
    observing nodes included, by an empty relation, and their values are
    lost.  Callers treat a missing count at the top of a plan as zero rows
    and recount the rest (see :func:`_recount`).
    """
    from py4j.protocol import Py4JJavaError
    try:
        v = o.get[key]
    except (Py4JJavaError, KeyError, ValueError):
        return None
    return int(v or 0)


def _count(cond) -> Any:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def _count_sql(cond: str, name: str) -> Any:
    """Rows where the SQL condition holds, as one expression (used on every batch)."""
    return F.expr(f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS {name}")


def parse_batch(raw: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Envelope + parse with the spec's schema: ``_src``, ``parsed``, ``parse_failed``."""
    schema = spec.flattener_schema
    if spec.flattener is not None and schema == "variant":
        return parse_messages(raw, spec.mappings, variant=True)
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    return parse_messages(raw, spec.mappings, strict=spec.strict_json, on_unknown=spec.on_unknown_type,
                          on_type_mismatch=spec.on_type_mismatch,
                          schema=schema if spec.flattener is not None else None)


def _slim(tagged: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Tagged rows whose message text is kept for error rows only: nothing else reads it again."""
    if any(c in (SOURCE_STRUCT, f"{SOURCE_STRUCT}.json_raw") for c in spec.dedup_order):
        return tagged
    fields = [f"IF({ERROR_REASON} IS NULL, NULL, {SOURCE_STRUCT}.{c}) AS {c}" if c == "json_raw" else f"{SOURCE_STRUCT}.{c}"
              for c in ENVELOPE]
    return tagged.withColumn(SOURCE_STRUCT, F.expr(f"struct({', '.join(fields)})"))


def transform_batch(parsed: DataFrame, spec: PipelineSpec, as_of: _dt.datetime | None = None, *,
                    observe: bool = True, persist: bool = False) -> BatchResult:
    """PIP-1: parsed messages -> (good rows, error rows), both lazy.

    ``observe=False`` leaves out the counting (a persisted batch is counted by :func:`batch_stats`).  ``persist``
    keeps what both branches start from: the tagged flat rows, or with hooks the parsed messages.

    ``parsed`` is the output of :func:`parse_batch` (persisted or not).  Good
    rows carry the mapped columns (or the hooks' columns), the load-date
    column last, plus ``_src`` for ordering and error rows; error rows have
    the 7-column error schema.
    """
    as_of = resolve_as_of(as_of if as_of is not None else spec.as_of)
    part = spec.partition_column
    keys = list(spec.primary_keys)
    ld = load_date(as_of, spec.date_format).alias(part)
    obs: dict[str, Observation] = {}

    if spec.flattener is None and spec.transformer is None:
        # One tagged frame, split by two filters: no union, no second parse.
        flat = parsed.select(*flatten_columns(spec.mappings, on_unknown=spec.on_unknown_type), ld,
                             F.col(SOURCE_STRUCT), F.col(PARSE_FAILED))
        tagged = flat.withColumn(ERROR_REASON, error_reason(keys))
        cached = tagged = _slim(tagged, spec).persist(StorageLevel.MEMORY_AND_DISK) if persist else tagged
        if observe:
            obs["split"] = _obs("split")
            tagged = tagged.observe(
                obs["split"], F.expr("count(1) AS n_in"),
                _count_sql(f"{ERROR_REASON} = '{JSON_PARSE_FAILURE}'", "n_parse_failure"),
                _count_sql(f"{ERROR_REASON} = '{NULL_PRIMARY_KEY}'", "n_null_key"))
        good, bad = split_bad_records(tagged, part, data_columns=spec.mapped_columns, topic=spec.topic,
                                      as_of=as_of, reserialize=spec.reserialize_null_key_rows)
        return BatchResult(good, bad, obs, tagged=tagged, cached=cached)

    # Hooks may change columns and rows: split parse failures first, then
    # run the hooks on the parsed rows, then split on the keys (SET-1 union).
    cached = parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK) if persist else parsed
    if observe:
        obs["parse"] = _obs("parse")
        parsed = parsed.observe(obs["parse"], F.expr("count(1) AS n_in"),
                                _count_sql(PARSE_FAILED, "n_parse_failure"))
    ok = parsed.filter(~F.col(PARSE_FAILED))
    reserved = [part, ERROR_REASON]
    if spec.flattener is not None:
        flat = apply_flattener(flattener_input(ok), spec.flattener, keys, spec.params, reserved=reserved)
    else:
        flat = ok.select(*flatten_columns(spec.mappings, on_unknown=spec.on_unknown_type), F.col(SOURCE_STRUCT))
    data_cols = [c for c in flat.columns if c != SOURCE_STRUCT]
    if spec.transformer is not None:
        flat = apply_transformer(flat, spec.transformer, keys, spec.params, expected=data_cols, reserved=reserved)
        data_cols = [c for c in flat.columns if c != SOURCE_STRUCT]
    flat = flat.select(*[F.col(quote_path(c)) for c in data_cols], ld,
                       *([F.col(SOURCE_STRUCT)] if SOURCE_STRUCT in flat.columns else []))
    tagged = flat.withColumn(ERROR_REASON, F.when(any_null(keys), F.lit(NULL_PRIMARY_KEY)))
    if observe:
        obs["keys"] = _obs("keys")
        tagged = tagged.observe(obs["keys"], F.expr("count(1) AS n_flat"),
                                _count_sql(f"{ERROR_REASON} IS NOT NULL", "n_null_key"))
    good, key_bad = split_bad_records(tagged, part, data_columns=data_cols, topic=spec.topic, as_of=as_of,
                                      reserialize=spec.reserialize_null_key_rows)
    parse_bad = to_error_rows(parsed.filter(F.col(PARSE_FAILED)).select(F.col(SOURCE_STRUCT), ld),
                              JSON_PARSE_FAILURE, part, identity=spec.reserialize_null_key_rows)
    return BatchResult(good, parse_bad.unionByName(key_bad), obs, tagged=tagged, parsed=parsed, cached=cached)


_ATTEMPT_FIELD = T.StructType([T.StructField(ATTEMPT, T.StringType(), True)])
_IDENTITY_FIELDS = T.StructType([T.StructField(n, t, True) for n, t in
                                 zip(IDENTITY, (T.StringType(), T.IntegerType(), T.LongType()))])


def lookback_rows(spark, path: str, spec: PipelineSpec, as_of: _dt.datetime, columns, *,
                  optional: T.StructType | None = None) -> DataFrame | None:
    """``columns`` of a path dataset inside the lookback window, listing only those partitions.

    Of atomic batches, the rows of committed attempts.
    """
    values = _lookback(spec, as_of)
    if not spec.atomic:
        return read_stored(spark, path, columns, spec.partition_column, values, optional=optional)
    attempts = committed_attempts(spark, spec.ledger_path)
    more = T.StructType([*(optional.fields if optional is not None else ()), *_ATTEMPT_FIELD.fields])
    return committed_rows(read_stored(spark, path, columns, spec.partition_column, values, optional=more), attempts)


def read_committed(spark, spec: PipelineSpec, what: str = "data") -> DataFrame | None:
    """The target's rows (``what="errors"``: the error rows) as readers should see them: whole batches only.

    Rows without an attempt, from before there was a ledger, are seen too.  The ledger is read before the rows.
    """
    if what not in ("data", "errors"):
        raise ValueError("what must be 'data' or 'errors'")
    path = spec.target.path if what == "data" else spec.error_path
    attempts = committed_attempts(spark, spec.ledger_path) if spec.ledger_path else None
    seen = read_rows(spark, path, spec.partition_column)
    if seen is None:
        return None
    fields = [f for f in seen.schema.fields if f.name not in (ATTEMPT, spec.partition_column)]
    part = T.StructField(spec.partition_column, T.StringType(), True)
    return committed_rows(spark.read.schema(T.StructType([*fields, *_ATTEMPT_FIELD.fields, part])).parquet(path), attempts)


def dedup_against_target(good: DataFrame, spec: PipelineSpec, as_of: _dt.datetime,
                         candidates: DataFrame | None = None, *, sketch: KeySketch | None = None,
                         use_index: bool = False) -> DataFrame:
    """JN-1 with FLT-10: anti join on the keys against the lookback window of the target.

    Catalog tables prune partitions through the catalog; Parquet paths are
    read partition folder by partition folder (:func:`read_partitions`).
    ``candidates`` (keys of the batch, of measured size) first restrict the
    existing keys by a broadcast semi join, so the lookback window is only
    scanned, never shuffled; the anti join then moves at most the batch's
    own keys.  Where they are too many for that, their ``sketch`` drops most
    of the other keys before the shuffle.  ``use_index`` reads the keys from
    the spec's key index instead, which lie as the join needs them.
    """
    spark = good.sparkSession
    if use_index:
        existing = indexed_keys(spark, spec.key_index, spec.primary_keys, spec.partition_column, _lookback(spec, as_of))
        check_key_types(existing, good, spec.primary_keys)
        return anti_join_existing(good, existing.distinct(), spec.primary_keys)
    if spec.target.is_table:
        existing = existing_keys(read_target(spark, spec.target), spec.primary_keys, spec.partition_column,
                                 spec.lookback_days, as_of, spec.date_format)
    else:
        rows = lookback_rows(spark, spec.target.path, spec, as_of, spec.primary_keys)
        existing = existing_keys(rows, spec.primary_keys, spec.partition_column, spec.lookback_days, as_of,
                                 spec.date_format)
    if existing is None:
        return good
    check_key_types(existing, good, spec.primary_keys)
    if candidates is not None:
        existing = restrict_to_keys(existing, candidates, spec.primary_keys)
    elif sketch is not None and all(_same_hash(existing.schema[k].dataType, good.schema[k].dataType) for k in spec.primary_keys):
        existing = sketch_keys(existing, sketch, spec.primary_keys)
    # Many stored copies of one key (loads outside the lookback, replays) would all meet in one
    # join task, and AQE cannot split the build side of an anti join.  distinct() collapses them
    # map-side (partial aggregation), and its hash partitioning is the one the join needs.
    existing = existing.distinct()
    return anti_join_existing(good, existing, spec.primary_keys)


def _lookback(spec: PipelineSpec, as_of: _dt.datetime) -> tuple[str, ...] | None:
    return None if spec.lookback_days is None else lookback_values(as_of, spec.lookback_days, spec.date_format)


def _same_hash(stored: T.DataType, batch: T.DataType) -> bool:
    """Whether equal values of the two types have equal hashes: one type, and not a floating one."""
    return stored == batch and not isinstance(stored, (T.FloatType, T.DoubleType))


def index_batch_keys(good: DataFrame, spec: PipelineSpec, as_of: _dt.datetime) -> None:
    """Add the batch's keys that the index lacks within the lookback, after the rows themselves are stored."""
    part = spec.partition_column
    keys = apply_rules(good, spec.rules).select(*[F.col(ident(k)) for k in spec.primary_keys]).distinct()
    known = indexed_keys(good.sparkSession, spec.key_index, spec.primary_keys, part, _lookback(spec, as_of))
    new = anti_join_existing(keys, known.distinct(), spec.primary_keys)
    append_keys(new.withColumn(part, load_date(as_of, spec.date_format)), spec.key_index, spec.primary_keys, part)


# Bytes per key row of a broadcast hash relation besides the
# variable-length key data: null bits, one 8-byte slot per key column and
# the hash map's entry overhead; variable-length values are padded to 8.
ROW_OVERHEAD = 48
SLOT = 8
PAD = 7
_BYTE_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def parse_bytes(text: str) -> int:
    """A Spark byte-size setting (``10485760``, ``10485760b``, ``10MB``, ``-1``) in bytes."""
    import re
    m = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)(?:i?b)?\s*", str(text).lower())
    if not m:
        raise ValueError(f"not a byte size: {text!r}")
    return int(m.group(1)) * _BYTE_UNITS[m.group(2)]


def broadcast_threshold(spark) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; 0 or less means never broadcast."""
    return parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))


def _key_bytes(cols) -> Any:
    """Upper bound of one key row's in-memory size, or None for key types not sized here."""
    width = F.lit(ROW_OVERHEAD + SLOT * len(cols)).cast("long")
    for c, dtype in cols:
        if isinstance(dtype, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(PAD)
        elif isinstance(dtype, T.DecimalType) and dtype.precision > 18:
            width = width + F.lit(16)
        elif not isinstance(dtype, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType,
                                    T.TimestampNTZType)):
            return None
    return width


class BatchStats(NamedTuple):
    """What the first job of a batch measures (see :func:`batch_stats`)."""

    n_in: int
    n_parse_failure: int
    n_flat: int                # rows that were tagged: after the hooks, where there are any
    n_null_key: int
    n_rules: int               # good rows that every rule keeps
    key_bytes: int | None      # bound of the good keys as a broadcast relation; None for key types not sized here
    error_bytes: int | None    # bound of the error rows' (topic, partition, offset) as one; None if a hook dropped them
    n_good: int = 0            # rows that are no errors: as many keys at most


def _position_bytes() -> Any:
    return (F.lit(ROW_OVERHEAD + SLOT * len(ERROR_KEYS) + PAD)
            + F.coalesce(F.octet_length(F.col(f"{SOURCE_STRUCT}.topic")), F.lit(0)))


def batch_stats(result: BatchResult, spec: PipelineSpec) -> BatchStats:
    """Stage counts of a persisted batch and upper bounds (bytes) of its keys and error positions as broadcast relations.

    One aggregation over the tagged rows (with hooks: the rows that they give, and one over the parsed ones), so it also
    fills the cache the writes read from.  Its value is the job's result, so tasks that run again after a lost executor
    count once, which an observation below a shuffle does not promise.
    """
    tagged = result.tagged
    reason, good = F.col(ERROR_REASON), F.col(ERROR_REASON).isNull()
    rules = rules_condition(spec.rules, tagged.drop(ERROR_REASON).schema)
    kept = good if rules is None else good & F.coalesce(rules, F.lit(False))
    width = _key_bytes([(F.col(ident(k)), tagged.schema[k].dataType) for k in spec.primary_keys])
    aggs = [F.expr("count(1) AS n_flat"), _count(reason == JSON_PARSE_FAILURE).alias("n_parse_failure"),
            _count(reason == NULL_PRIMARY_KEY).alias("n_null_key"), _count(kept).alias("n_rules"),
            (F.lit(None).cast("long") if width is None else F.sum(F.when(good, width).otherwise(0))).alias("key_bytes")]
    if SOURCE_STRUCT in tagged.columns:
        aggs.append(F.sum(F.when(reason.isNotNull(), _position_bytes()).otherwise(0)).cast("long").alias("error_bytes"))
    row = tagged.agg(*aggs).collect()[0].asDict()  # a global aggregate is one row; no LIMIT job
    got = {k: None if v is None and k == "key_bytes" and width is None else int(v or 0) for k, v in row.items()}
    got.setdefault("error_bytes", None)
    got["n_good"] = got["n_flat"] - got["n_null_key"] - got["n_parse_failure"]
    if result.parsed is None:
        return BatchStats(n_in=got["n_flat"], **got)
    failed = F.col(PARSE_FAILED)
    p = result.parsed.agg(F.count(F.lit(1)).alias("n"), _count(failed).alias("bad"),
                          F.sum(F.when(failed, _position_bytes()).otherwise(0)).alias("bytes")).collect()[0]
    got["n_parse_failure"] = int(p["bad"] or 0)
    if got["error_bytes"] is not None:
        got["error_bytes"] += int(p["bytes"] or 0)
    return BatchStats(n_in=int(p["n"]), **got)


def error_positions(result: BatchResult) -> DataFrame | None:
    """(topic, partition, offset) of every message that becomes an error row; None if a hook dropped them."""
    if SOURCE_STRUCT not in result.tagged.columns:
        return None
    position = [F.col(f"{SOURCE_STRUCT}.{c}").alias(c) for c in ERROR_KEYS]
    out = result.tagged.filter(F.col(ERROR_REASON).isNotNull()).select(*position)
    if result.parsed is not None:
        out = out.unionByName(result.parsed.filter(F.col(PARSE_FAILED)).select(*position))
    return out


def candidate_keys(result: BatchResult, spec: PipelineSpec) -> DataFrame:
    """Keys of every good row: a superset of the keys that reach the anti join."""
    return result.tagged.filter(F.col(ERROR_REASON).isNull()).select(*[F.col(ident(k)) for k in spec.primary_keys])


def _narrow_source(good: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Keep only the envelope fields the in-batch order needs.

    The good branch never writes the envelope; carrying the raw message text
    through the dedup shuffle would roughly double its bytes.
    """
    if SOURCE_STRUCT not in good.columns:
        return good
    prefix = SOURCE_STRUCT + "."
    fields = [c[len(prefix):] for c in spec.dedup_order if c.startswith(prefix)] if spec.dedup_within_batch else []
    if not fields:
        return good.drop(SOURCE_STRUCT)
    return good.withColumn(SOURCE_STRUCT, F.struct(*[F.col(prefix + f).alias(f) for f in fields]))


def good_rows_plan(good: DataFrame, spec: PipelineSpec, as_of: _dt.datetime, *, dedup: bool = True,
                   candidates: DataFrame | None = None, sketch: KeySketch | None = None,
                   use_index: bool = False) -> tuple[DataFrame, dict[str, Observation]]:
    """PIP-2 good branch: rules -> in-batch dedup -> anti join, each stage observed."""
    obs = {k: _obs(k) for k in ("rules", "batch_dedup", "written")}
    good = _narrow_source(good, spec)
    ruled = apply_rules(good, spec.rules).observe(obs["rules"], F.expr("count(1) AS n"))
    if spec.dedup_within_batch:
        order = [c for c in spec.dedup_order if not c.startswith(SOURCE_STRUCT) or SOURCE_STRUCT in good.columns]
        ruled = dedup_within_batch(ruled, spec.primary_keys, order)
    ruled = ruled.observe(obs["batch_dedup"], F.expr("count(1) AS n"))
    new = dedup_against_target(ruled, spec, as_of, candidates, sketch=sketch, use_index=use_index) if dedup else ruled
    out = new.drop(SOURCE_STRUCT) if SOURCE_STRUCT in new.columns else new
    return out.observe(obs["written"], F.expr("count(1) AS n")), obs


def error_rows_plan(bad: DataFrame, spec: PipelineSpec, as_of: _dt.datetime,
                    candidates: DataFrame | None = None) -> tuple[DataFrame, Observation]:
    """PIP-2 bad branch: optional idempotency anti join on the source position (JN-4).

    The position is the envelope's, or for rebuilt rows the one kept beside it.  ``candidates`` (the batch's error
    positions, of measured size) restrict the stored errors by a broadcast semi join first, as for the target.
    """
    out = bad
    if spec.idempotent_errors and spec.error_path:
        stored = lookback_rows(bad.sparkSession, spec.error_path, spec, as_of, ERROR_KEYS, optional=_IDENTITY_FIELDS)
        known = None if stored is None else stored.select(
            *[F.coalesce(i, k).alias(k) for k, i in zip(ERROR_KEYS, IDENTITY)]).filter("kafka_offset >= 0")
        if candidates is not None:
            known = restrict_to_keys(known, candidates, ERROR_KEYS)
        out = anti_join_errors(bad, known, IDENTITY if IDENTITY[2] in bad.columns else ERROR_KEYS)
    o = _obs("bad_written")
    return out.observe(o, F.expr("count(1) AS n")), o


def write_good(df: DataFrame, spec: PipelineSpec) -> None:
    """Append the good rows.

    With in-batch dedup on, the plan already ends in the dedup aggregate's
    shuffle (hash-partitioned by key, so not skewed; the anti join keeps
    that partitioning), and AQE sizes those partitions.  A rebalance would
    shuffle every written row a second time for the same file sizes, so it
    is only added when no such shuffle exists.
    """
    rebalance = not spec.dedup_within_batch
    if spec.target.is_table:
        append_table(df, spec.target.table, files=spec.files_per_write,
                     max_records_per_file=spec.max_records_per_file, rebalance=rebalance)
    else:
        append_parquet(df, spec.target.path, spec.partition_column, files=spec.files_per_write,
                       max_records_per_file=spec.max_records_per_file, rebalance=rebalance)


def process_batch(raw: DataFrame, batch_id: int, spec: PipelineSpec, *, persist: bool = True,
                  reprocess: bool = False, as_of: _dt.datetime | None = None, run_id: str = "", resume: bool = True,
                  on_step: Callable[[str], None] | None = None) -> BatchMetrics:
    """PIP-2: one (micro-)batch of Kafka-shaped rows -> target + error path (+ audit).

    ``run_id`` tells runs apart whose batch ids start again at 0 (a stream's query id, a backfill's own id): in the
    audit and in the ledger a batch is known by both.

    ``dedup_mode="reprocess"`` runs the target anti join only when
    ``reprocess`` is true, or when the ledger says that the batch had begun before (AUD-4); ``"always"`` runs it on
    every batch.  ``resume=False`` spares the look into the ledger where the batch cannot have begun before.
    ``on_step`` is called after each step of the batch, before the ledger notes it.
    """
    t0 = time.perf_counter()
    as_of = resolve_as_of(as_of if as_of is not None else spec.as_of)
    spark = raw.sparkSession
    if not persist and raw.isEmpty():  # AGG-2: a LIMIT 1 job; nothing else runs for an empty batch
        return BatchMetrics(batch_id, as_of=as_of, seconds=time.perf_counter() - t0)
    log = BatchLog(spark, spec, run_id, batch_id, resume=resume, on_step=on_step)
    if log.has(AUDITED):
        return BatchMetrics(batch_id, as_of=as_of, resumed_from=AUDITED, seconds=time.perf_counter() - t0)
    result = transform_batch(parse_batch(raw, spec), spec, as_of, observe=not persist, persist=persist)
    try:
        stats = None
        if persist:
            # AGG-2, the counts and the cache fill in one job; the measured sizes decide the semi joins.
            stats = batch_stats(result, spec)
            if stats.n_in == 0:
                return BatchMetrics(batch_id, as_of=as_of, seconds=time.perf_counter() - t0)
        m = load_batch(result, batch_id, spec, as_of, stats, log, reprocess=reprocess)
        if spec.audit_path or spec.audit_table:
            append_batch_audit(batch_offsets(result.cached), m, spec, run_id)
        log.record(AUDITED, m.n_written, m.n_bad_written)
    finally:
        if persist:
            result.cached.unpersist()
    m.seconds = time.perf_counter() - t0
    return m


def load_batch(result: BatchResult, batch_id: int, spec: PipelineSpec, as_of: _dt.datetime, stats: BatchStats | None,
               log: BatchLog, *, reprocess: bool = False) -> BatchMetrics:
    """Append the good rows and the error rows of a transformed batch, leaving out what the ledger says is done."""
    spark = result.good.sparkSession
    dedup = spec.dedup_mode == "always" or reprocess or (log.repeated and not spec.atomic)
    # the index lacks what was stored just before a stop
    use_index = bool(spec.key_index) and not reprocess and not log.repeated
    candidates = error_candidates = sketch = None
    if stats is not None:
        limit = broadcast_threshold(spark)
        restrict = spec.restrict_existing
        if restrict and dedup and not use_index and stats.key_bytes:
            if stats.key_bytes <= limit:
                candidates = candidate_keys(result, spec)
            elif share_kept(stats.n_good, sketch_maps(limit)) <= MAX_KEPT:
                sketch = build_sketch(candidate_keys(result, spec), spec.primary_keys, limit, stats.n_good)
        if restrict and stats.error_bytes is not None and 0 < stats.error_bytes <= limit:
            error_candidates = error_positions(result)
    if not log.has(DATA):
        log.record(BEGUN)
    attempt = F.lit(log.attempt).alias(ATTEMPT)
    good_obs: dict[str, Observation] | None = None
    if not log.has(DATA):
        good, good_obs = good_rows_plan(result.good, spec, as_of, dedup=dedup, candidates=candidates, sketch=sketch,
                                        use_index=use_index)
        write_good(good.select("*", attempt) if spec.atomic else good, spec)
    m = _metrics(batch_id, result, good_obs, as_of, spec, stats, log.found.n_written if good_obs is None else None)
    m.dedup_applied = dedup
    m.load_date = _format_date(as_of, spec.date_format)
    m.resumed_from = None if log.found is None else log.found.step
    if not log.has(DATA):
        log.record(DATA, m.n_written)
    if spec.key_index and not log.has(ERRORS):
        index_batch_keys(result.good, spec, as_of)
    # A batch measured to have no bad record skips the error branch (its read and its job).
    clean = stats is not None and stats.n_parse_failure + stats.n_null_key == 0
    if log.has(ERRORS):
        m.n_bad_written = log.found.n_bad_written
    else:
        if spec.capture_errors and spec.error_path and not clean:
            bad, bad_obs = error_rows_plan(result.bad, spec, as_of, error_candidates)
            append_parquet(bad.select("*", attempt) if spec.atomic else bad, spec.error_path, spec.partition_column,
                           files=spec.files_per_write)
            m.n_bad_written = observed(bad_obs, "n") or 0
        log.record(ERRORS, m.n_written, m.n_bad_written)
    return m


def append_batch_audit(offsets: DataFrame, m: BatchMetrics, spec: PipelineSpec, run_id: str) -> None:
    """The batch's audit rows (AUD-1); of a batch that is run again, the reader takes the last ones."""
    rows = audit_rows(offsets, _audit_counts(m), app=spec.app_name, batch_id=m.batch_id, recorded_at=m.as_of, run_id=run_id)
    append_audit(rows, spec.audit_path, table=spec.audit_table)


#: Counts of slices that add up to the batch's.
SUMMED = ("n_in", "n_parse_failure", "n_null_key", "n_hook_removed", "n_filtered", "n_duplicate_in_batch",
          "n_duplicate_target", "n_written", "n_bad_written")


def _format_date(as_of: _dt.datetime, fmt: str) -> str:
    """The batch's load-date text for the metrics record, formatted like the data column."""
    return lookback_values(as_of, 0, fmt)[0]


def _audit_counts(m: BatchMetrics) -> dict[str, int]:
    return {"n_in": m.n_in, "n_bad": m.n_bad, "n_filtered": m.n_filtered, "n_duplicate": m.n_duplicate,
            "n_written": m.n_written}


def _recount(result: BatchResult, spec: PipelineSpec) -> dict[str, int]:
    """Stage counts by aggregation over the (persisted) batch.

    Only needed when the written set was empty and AQE dropped the observed
    nodes with it; one job (two with hooks), partial aggregation, no collect.
    """
    tagged = result.tagged
    good_schema = tagged.drop(ERROR_REASON).schema
    cond = rules_condition(spec.rules, good_schema)
    ok = F.col(ERROR_REASON).isNull()
    kept = ok if cond is None else ok & F.coalesce(cond, F.lit(False))
    distinct = (F.count_distinct(F.when(kept, F.struct(*[F.col(quote_path(k)) for k in spec.primary_keys])))
                if spec.dedup_within_batch else _count(kept))
    row = tagged.agg(F.count(F.lit(1)).alias("n_flat"),
                     _count(F.col(ERROR_REASON) == JSON_PARSE_FAILURE).alias("n_parse_failure"),
                     _count(F.col(ERROR_REASON) == NULL_PRIMARY_KEY).alias("n_null_key"),
                     _count(kept).alias("n_rules"), distinct.alias("n_batch")).first()
    out = {k: int(row[k] or 0) for k in ("n_flat", "n_parse_failure", "n_null_key", "n_rules", "n_batch")}
    out["n_in"] = out["n_flat"]
    if result.parsed is not None:
        p = result.parsed.agg(F.count(F.lit(1)).alias("n_in"),
                              _count_sql(PARSE_FAILED, "n_parse_failure")).first()
        out["n_in"], out["n_parse_failure"] = int(p["n_in"]), int(p["n_parse_failure"] or 0)
    return out


def _metrics(batch_id: int, result: BatchResult, good_obs: dict[str, Observation] | None, as_of: _dt.datetime,
             spec: PipelineSpec, stats: BatchStats | None = None, n_written: int | None = None) -> BatchMetrics:
    """The counts of a batch whose good rows have been written; ``n_written`` where an earlier attempt wrote them."""
    m = BatchMetrics(batch_id, as_of=as_of)
    if good_obs is None:
        c = _recount(result, spec)
        m.n_in, m.n_parse_failure, m.n_null_key, m.n_written = c["n_in"], c["n_parse_failure"], c["n_null_key"], n_written or 0
        if stats is not None:
            m.n_in, m.n_parse_failure = stats.n_in, stats.n_parse_failure
        return _differences(m, result, c["n_flat"], c["n_rules"], c["n_batch"])
    written = observed(good_obs["written"], "n")
    n_batch = observed(good_obs["batch_dedup"], "n") if written is not None else None
    if stats is not None:
        m.n_in, m.n_parse_failure, m.n_null_key = stats.n_in, stats.n_parse_failure, stats.n_null_key
        n_flat, n_rules, m.n_written = stats.n_flat, stats.n_rules, written or 0
        if n_batch is None:
            n_batch = _recount(result, spec)["n_batch"]
    elif written is None:
        c = _recount(result, spec)
        m.n_in, m.n_parse_failure, m.n_null_key = c["n_in"], c["n_parse_failure"], c["n_null_key"]
        n_flat, n_rules, n_batch, m.n_written = c["n_flat"], c["n_rules"], c["n_batch"], 0
    elif "split" in result.observations:
        s = result.observations["split"]
        m.n_in, m.n_parse_failure = observed(s, "n_in"), observed(s, "n_parse_failure")
        m.n_null_key, n_flat = observed(s, "n_null_key"), observed(s, "n_in")
        n_rules = observed(good_obs["rules"], "n")
        m.n_written = written
    else:
        p, k = result.observations["parse"], result.observations["keys"]
        m.n_in, m.n_parse_failure = observed(p, "n_in"), observed(p, "n_parse_failure")
        m.n_null_key, n_flat = observed(k, "n_null_key"), observed(k, "n_flat")
        n_rules = observed(good_obs["rules"], "n")
        m.n_written = written
    return _differences(m, result, n_flat, n_rules, n_batch)


def _differences(m: BatchMetrics, result: BatchResult, n_flat: int, n_rules: int, n_batch: int) -> BatchMetrics:
    if result.parsed is not None:
        m.n_hook_removed = m.n_in - m.n_parse_failure - n_flat
    else:
        n_flat = m.n_in - m.n_parse_failure  # the tagged frame also holds the parse failures
    n_good = n_flat - m.n_null_key
    m.n_filtered = n_good - n_rules
    m.n_duplicate_in_batch = n_rules - n_batch
    m.n_duplicate_target = n_batch - m.n_written
    return m


def run_batch(raw: DataFrame, spec: PipelineSpec, *, batch_id: int = 0, run_id: str | None = None, **kw) -> BatchMetrics:
    """PIP-3: the same processing over a bounded input (replay, backfill), as a run of its own."""
    return process_batch(raw, batch_id, spec, run_id=run_id or uuid.uuid4().hex, **kw)


def run_slices(raw: DataFrame, spec: PipelineSpec, slices: int, *, run_id: str | None = None,
               as_of: _dt.datetime | None = None, reprocess: bool = False,
               on_step: Callable[[str], None] | None = None) -> list[BatchMetrics]:
    """PIP-3 for a range too large to persist at once: one batch per slice of the keys.

    A slice is a remainder of the hash of the primary keys, so all copies of a key are in one slice, wherever they lie in
    the source: in-batch dedup keeps the row that it would keep in one batch over everything, and no slice need look for
    what another has written.  Rows without a key or a parse are errors, dealt by position and text.  Every row is in a
    slice, with or without an offset.

    The messages are parsed once (with hooks, once for the rows and once for the parse failures) and staged by slice in the
    session's shared folder; each slice reads its own folder.  The clock is the same for all slices.  The audit gets one row
    for the whole range, after the last slice, since offsets are done only then.  With a ledger, a run that is started again
    with its ``run_id`` leaves out the slices that are done.
    """
    if slices < 1:
        raise ValueError("slices must be at least 1")
    run_id = run_id or uuid.uuid4().hex
    as_of = resolve_as_of(as_of if as_of is not None else spec.as_of)
    staged = stage_slices(transform_batch(parse_batch(raw, spec), spec, as_of, observe=False), spec, slices, as_of)
    out = []
    for k in range(slices):
        t0 = time.perf_counter()
        log = BatchLog(raw.sparkSession, spec, run_id, k, on_step=on_step)
        part = staged(k)
        stats = batch_stats(part, spec)
        if part.parsed is not None:  # the staged failures; what the hooks removed is in no slice
            stats = stats._replace(n_in=stats.n_in + stats.n_flat)
        m = load_batch(part, k, spec, as_of, stats, log, reprocess=reprocess) if stats.n_in else BatchMetrics(k, as_of=as_of)
        if k < slices - 1 and not log.has(AUDITED):
            log.record(AUDITED, m.n_written, m.n_bad_written)
        m.seconds = time.perf_counter() - t0
        out.append(m)
    if spec.transformer is not None or spec.flattener is not None:
        out[0].n_hook_removed = raw.count() - sum(m.n_in for m in out)
        out[0].n_in += out[0].n_hook_removed
    if not log.has(AUDITED):
        if spec.audit_path or spec.audit_table:
            total = BatchMetrics(slices - 1, as_of=as_of, **{c: sum(getattr(m, c) for m in out) for c in SUMMED})
            append_batch_audit(batch_offsets(project_envelope(raw)), total, spec, run_id)
        log.record(AUDITED, out[-1].n_written, out[-1].n_bad_written)
    return out


def stage_slices(result: BatchResult, spec: PipelineSpec, slices: int, as_of: _dt.datetime) -> Callable[[int], BatchResult]:
    """Write a transformed batch by slice of its keys; gives the batch of one slice, read from there."""
    root = fresh_dir(result.good.sparkSession, "slices")
    keys = list(spec.primary_keys)

    def write(df: DataFrame, columns, name: str) -> tuple[str, T.StructType, str]:
        slice_of = free_prefix(df, "_slice")
        hashed = df.withColumn(slice_of, F.pmod(F.xxhash64(*columns), F.lit(slices)).cast("int"))
        hashed.write.partitionBy(slice_of).parquet(f"{root}/{name}")
        return f"{root}/{name}", df.schema, slice_of

    def read(written: tuple[str, T.StructType, str], k: int) -> DataFrame:
        path, schema, slice_of = written
        whole = T.StructType([*schema.fields, T.StructField(slice_of, T.IntegerType())])
        return result.good.sparkSession.read.schema(whole).parquet(path).filter(F.col(slice_of) == k).drop(slice_of)

    tagged = _slim(result.tagged, spec) if result.parsed is None else result.tagged
    nulls = any_null(keys)
    place = [F.col(f"{SOURCE_STRUCT}.{c}") for c in ERROR_KEYS] if SOURCE_STRUCT in tagged.columns else []
    rows = write(tagged, [F.when(~nulls, F.xxhash64(*[F.col(quote_path(c)) for c in keys])), *[F.when(nulls, c) for c in place]], "rows")
    failures = None
    if result.parsed is not None:
        parsed = result.parsed.filter(F.col(PARSE_FAILED)).select(SOURCE_STRUCT, PARSE_FAILED)
        failures = write(parsed, [f"{SOURCE_STRUCT}.{c}" for c in (*ERROR_KEYS, "json_raw")], "failures")
    data = [c for c in tagged.columns if c not in (SOURCE_STRUCT, ERROR_REASON, PARSE_FAILED, spec.partition_column)]

    def batch(k: int) -> BatchResult:
        part = read(rows, k)
        good, bad = split_bad_records(part, spec.partition_column, data_columns=data, topic=spec.topic, as_of=as_of,
                                      reserialize=spec.reserialize_null_key_rows)
        if failures is None:
            return BatchResult(good, bad, tagged=part)
        failed = read(failures, k)
        ld = load_date(as_of, spec.date_format).alias(spec.partition_column)
        return BatchResult(good, to_error_rows(failed.select(F.col(SOURCE_STRUCT), ld), JSON_PARSE_FAILURE, spec.partition_column,
                                               identity=spec.reserialize_null_key_rows).unionByName(bad), tagged=part, parsed=failed)
    return batch
