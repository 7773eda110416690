"""Application entry point: run one configured ingestion stream.

The whole job is described by one JSON file: the pipeline spec (the keys
of :meth:`PipelineSpec.from_dict`) plus a ``source`` and a ``stream``
section::

    {"app_name": "events_loader", "topic": "customer_events",
     "json": {"groups": [...], "type_overrides": [...]}, "primary_keys": ["event_id"],
     "target": {"table": "db.events"}, "error_path": "s3://…/errors", "rules": [...],
     "source": {"format": "kafka", "bootstrap_servers": "broker:9093",
                "starting_offsets": "earliest", "max_offsets_per_trigger": 100000,
                "security_protocol": "SSL", "ssl_file": "kafka_tls.json"},
     "stream": {"checkpoint": "s3://…/checkpoints/events",
                "trigger": {"processingTime": "15 minutes"}}}

Run it with ``spark-submit`` (the session, its master and its confs belong
to the submitter; this module sets none)::

    spark-submit --py-files streamload.zip streamload/app.py --config events.json
    python -m streamload --config events.json       # same, with pyspark on the path

A job in the reference's own layout (``spark`` / ``kafka`` / ``application``
/ ``filter`` / ``error`` sections, hyphenated keys, e.g. its HOCON file
converted to JSON) is accepted as well; custom hook classes become
``package.module:function`` names of Python callables.

``source.format`` ``"replay"`` reads Kafka-shaped Parquet files instead
(backfills, tests).  ``starting_offsets: "audit"`` starts from the offsets
recorded in ``audit_path`` (only consulted when the checkpoint is new).
TLS secrets stay out of the spec: ``ssl_file`` names a separate JSON file.
Every micro-batch logs one JSON line with its stage counts.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Mapping, Sequence
from typing import Any

if __name__ == "__main__" and not __package__:  # run as a script: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from streamload.plans.batch import BatchMetrics
from streamload.sources.kafka import read_kafka
from streamload.sources.replay import read_replay
from streamload.spec import PipelineSpec, SpecError
from streamload.streaming.recovery import starting_offsets_from_audit
from streamload.streaming.runner import FIRST, run_stream

# Top-level config sections that are not part of the pipeline spec.
APP_SECTIONS = ("source", "stream")


def load_config(path: str) -> dict[str, Any]:
    """The job description (a small driver-side file, shipped with ``--files`` on a cluster)."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def load_callable(name: str):
    """A hook named ``package.module:function`` (the reference names classes; ours are callables)."""
    import importlib
    module, _, attr = name.partition(":")
    if not module or not attr:
        raise SpecError(f"hook {name!r} must look like 'package.module:function'")
    return getattr(importlib.import_module(module), attr)


def from_reference_layout(cfg: Mapping[str, Any]) -> dict[str, Any]:
    """Translate a job written in the reference's config layout into ours.

    The layout has ``spark``, ``kafka``, ``application``, ``filter`` and
    ``error`` sections with hyphenated keys (e.g. a HOCON file converted
    to JSON).  A ``source`` or ``stream`` section of ours, when present,
    overrides what the Kafka and Spark sections say.  Two things stay ours:
    ``failOnDataLoss`` is true unless ``fail_on_data_loss`` says otherwise,
    and TLS material comes from ``ssl_file``, not from JVM properties.
    """
    sp, kf = cfg.get("spark", {}), cfg.get("kafka", {})
    app, flt, err = cfg.get("application", {}), cfg.get("filter", {}), cfg.get("error", {})
    js = app.get("json", {})
    if sp.get("enable-hive"):
        db, tbl = app.get("hive-database"), app.get("hive-table")
        target = {"table": f"{db}.{tbl}" if db else tbl}
    else:
        target = {"path": app.get("output-path")}
    out: dict[str, Any] = {
        "app_name": sp.get("app-name", "streamload"),
        "topic": kf.get("topic", ""),
        "target": target,
        "partition_column": app.get("partition-column", "audit_load_date"),
        "date_format": app.get("date-format", "yyyy-MM-dd"),
        "primary_keys": list(app.get("primary-keys", [])),
        "lookback_days": app.get("dedup-lookback-days", 2),
        "json": {k: v for k, v in (("groups", js.get("groups")), ("fields", js.get("fields")),
                                   ("type_overrides", js.get("type-overrides"))) if v is not None},
        "rules": list(flt.get("rules", [])),
        "error_path": err.get("error-path") or None,
        "capture_errors": bool(err.get("enable-error-capture", True)),
        "params": dict(app.get("extra-params", {})),
    }
    for ours, theirs in (("transformer", "custom-transformer-class"), ("flattener", "custom-flatten-class")):
        if app.get(theirs):
            out[ours] = app[theirs]
    source = {"format": "kafka", "topic": kf.get("topic"), "bootstrap_servers": kf.get("bootstrap-servers"),
              "starting_offsets": kf.get("starting-offsets", "earliest"),
              "security_protocol": kf.get("security-protocol", "PLAINTEXT")}
    if kf.get("group-id"):
        source["group_id"] = kf["group-id"]
    stream: dict[str, Any] = {"checkpoint": sp.get("checkpoint-location")}
    if sp.get("trigger-interval"):
        stream["trigger"] = {"processingTime": sp["trigger-interval"]}
    out["source"] = dict(cfg["source"]) if "source" in cfg else source
    out["stream"] = {**stream, **dict(cfg.get("stream") or {})}
    return out


def is_reference_layout(cfg: Mapping[str, Any]) -> bool:
    return "application" in cfg and "primary_keys" not in cfg


def build_spec(cfg: Mapping[str, Any]) -> PipelineSpec:
    d = {k: v for k, v in cfg.items() if k not in APP_SECTIONS}
    hooks = {k: load_callable(d.pop(k)) for k in ("transformer", "flattener") if isinstance(d.get(k), str)}
    return PipelineSpec.from_dict(d, **hooks)


def build_source(spark: SparkSession, cfg: Mapping[str, Any], spec: PipelineSpec) -> DataFrame:
    """The streaming source named by ``cfg["source"]``."""
    src = dict(cfg.get("source") or {})
    fmt = src.pop("format", "kafka")
    if fmt == "replay":
        return read_replay(spark, src["path"], max_files_per_trigger=src.get("max_files_per_trigger"))
    if fmt != "kafka":
        raise SpecError(f"unknown source format {fmt!r} (kafka | replay)")
    topic = src.pop("topic", None) or spec.topic
    if not topic:
        raise SpecError("a Kafka source needs a topic")
    servers = src.pop("bootstrap_servers")
    ssl = dict(src.pop("ssl", None) or {})
    ssl_file = src.pop("ssl_file", None)
    if ssl_file:
        ssl.update(load_config(ssl_file))
    partitions = src.pop("partitions", None)
    start = src.pop("starting_offsets", "earliest")
    if start == "audit":
        if not (spec.audit_path or spec.audit_table):
            raise SpecError('starting_offsets "audit" needs audit_path or audit_table')
        start = starting_offsets_from_audit(spark, spec.audit_path, topic, app=spec.app_name, partitions=partitions,
                                            audit_table=spec.audit_table,
                                            ledger_path=spec.ledger_path if spec.atomic else None) or "earliest"
    return read_kafka(spark, topic, servers, starting_offsets=start, ssl=ssl or None, **src)


def log_metrics(m: BatchMetrics) -> None:
    """One JSON line per micro-batch (the reference prints its counts per batch)."""
    d = m.as_dict()
    d["as_of"] = None if m.as_of is None else m.as_of.isoformat()
    print(json.dumps(d, sort_keys=True), flush=True)


def run_app(spark: SparkSession, cfg: Mapping[str, Any], *, on_metrics=log_metrics) -> StreamingQuery:
    """Start the configured stream and return its query (not awaited)."""
    if is_reference_layout(cfg):
        cfg = from_reference_layout(cfg)
    spec = build_spec(cfg)
    stream = dict(cfg.get("stream") or {})
    if not stream.get("checkpoint"):
        raise SpecError("stream.checkpoint is required")
    source = build_source(spark, cfg, spec)
    if spec.target.is_table and not spark.catalog.tableExists(spec.target.table):
        raise SpecError(f"table {spec.target.table} does not exist for this session; create it first, and start the "
                        "session with the catalog that holds it (a Hive catalog: spark.sql.catalogImplementation=hive)")
    from_audit = (cfg.get("source") or {}).get("starting_offsets") == "audit"
    # a new checkpoint, or one started from the audit, may repeat anything; an old one, the batch it stopped in
    reprocess = stream.get("reprocess", from_audit or checkpoint_is_new(spark, stream["checkpoint"]) or FIRST)
    return run_stream(source, spec, checkpoint=stream["checkpoint"], trigger=stream.get("trigger"),
                      query_name=stream.get("query_name") or spec.app_name, on_metrics=on_metrics, reprocess=reprocess)


def checkpoint_is_new(spark: SparkSession, checkpoint: str) -> bool:
    """Whether no query has started from this checkpoint (a query writes its id there first).

    Batches may then repeat what the target already has, so a ``dedup_mode="reprocess"`` job compares with it.
    """
    from .sources.target import path_exists
    return not path_exists(spark, f"{checkpoint.rstrip('/')}/metadata")


def main(argv: Sequence[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="streamload", description=__doc__.splitlines()[0])
    p.add_argument("--config", required=True, help="job description (JSON)")
    p.add_argument("--no-wait", action="store_true", help="start the query and return")
    args = p.parse_args(argv)
    cfg = load_config(args.config)
    spark = SparkSession.builder.appName(cfg.get("app_name", "streamload")).getOrCreate()
    q = run_app(spark, cfg)
    if not args.no_wait:
        q.awaitTermination()
        if q.exception() is not None:
            print(str(q.exception()), file=sys.stderr)
            return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
