"""The configured application: JSON job description -> running stream."""

import json

import pytest

from conftest import SF001
from streamload import app
from streamload.plans.batch import process_batch
from streamload.sinks import append_parquet
from streamload.sources import existing_rows_from_events, messages_from_events, write_replay
from streamload.sources.target import read_rows
from streamload.spec import SpecError

CONFIG = {
    "app_name": "events_loader",
    "topic": "events",
    "json": {"groups": [{"path": "", "columns": "event_id, event_timestamp"},
                        {"path": "actor", "columns": "user_id, kind:event_type"},
                        {"path": "measure", "columns": "value"},
                        {"path": "props", "columns": "k"}],
             "type_overrides": [{"name": "user_id", "type": "long"}, {"name": "value", "type": "double"},
                                {"name": "k", "type": "int"}]},
    "primary_keys": ["event_id"],
    "rules": [{"field": "event_type", "operator": "not_equals", "value": "error"}],
    "lookback_days": 2,
    "as_of": "2024-01-30",
}


def _job(root, **source):
    cfg = dict(CONFIG, target={"path": f"{root}/target"}, error_path=f"{root}/errors",
               source=source, stream={"checkpoint": f"{root}/ckpt", "trigger": {"availableNow": True}})
    return cfg


def _keys(spark, path):
    return sorted(r[0] for r in read_rows(spark, path).select("event_id").collect())


def test_spec_ignores_app_sections_and_reads_clock():
    spec = app.build_spec(_job("/x", format="replay", path="/y"))
    assert spec.target.path == "/x/target" and spec.as_of.isoformat() == "2024-01-30T00:00:00"
    assert [m.name for m in spec.mappings] == ["event_id", "event_timestamp", "user_id", "event_type", "value", "k"]


def test_main_runs_the_configured_stream(spark, workdir, tmp_path):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    msgs = messages_from_events(events)
    write_replay(msgs, f"{workdir}/replay", files=3)
    for side in ("app", "batch"):
        append_parquet(existing_rows_from_events(events), f"{workdir}/{side}/target", "audit_load_date")
    cfg = _job(f"{workdir}/app", format="replay", path=f"{workdir}/replay", max_files_per_trigger=1)
    path = tmp_path / "job.json"
    path.write_text(json.dumps(cfg))
    assert app.main(["--config", str(path)]) == 0
    ref = app.build_spec(_job(f"{workdir}/batch", format="replay", path=f"{workdir}/replay"))
    process_batch(msgs, 0, ref)
    assert _keys(spark, f"{workdir}/app/target") == _keys(spark, f"{workdir}/batch/target")


def test_kafka_source_options_audit_start_and_secrets(spark, workdir, tmp_path, monkeypatch):
    seen = {}

    def fake_read_kafka(spark_, topic, servers, **kw):
        seen.update(topic=topic, servers=servers, **kw)
        return spark_.range(0)

    monkeypatch.setattr(app, "read_kafka", fake_read_kafka)
    audit = f"{workdir}/audit"
    spark.createDataFrame(
        [("events_loader", "events", 0, {0: 10, 1: 7}), ("events_loader", "events", 1, {0: 12})],
        "app string, topic string, batch_id long, next_offsets map<int,bigint>").write.parquet(audit)
    tls = tmp_path / "tls.json"
    tls.write_text(json.dumps({"truststore.location": "/certs/ts.jks", "truststore.password": "pw"}))
    cfg = dict(_job(workdir, format="kafka", bootstrap_servers="b:9093", starting_offsets="audit",
                    partitions=3, security_protocol="SASL_SSL", ssl_file=str(tls),
                    max_offsets_per_trigger=1000), audit_path=audit)
    app.build_source(spark, cfg, app.build_spec(cfg))
    assert seen["topic"] == "events" and seen["servers"] == "b:9093"
    # partition 2 was never audited: -2 = earliest
    assert json.loads(seen["starting_offsets"]) == {"events": {"0": 12, "1": 7, "2": -2}}
    assert seen["ssl"]["truststore.password"] == "pw" and seen["max_offsets_per_trigger"] == 1000


def test_bad_configs_fail_before_starting(spark):
    with pytest.raises(SpecError):
        app.run_app(spark, dict(_job("/x", format="replay", path="/y"), stream={}))
    with pytest.raises(SpecError):
        app.build_source(spark, _job("/x", format="csv"), app.build_spec(_job("/x")))
    with pytest.raises(SpecError):
        cfg = _job("/x", format="kafka", bootstrap_servers="b:1", starting_offsets="audit")
        app.build_source(spark, cfg, app.build_spec(cfg))


def tag_kind(df):
    """A transformer named in a job file as 'test_app:tag_kind'."""
    from pyspark.sql import functions as F
    return df.withColumn("event_type", F.upper("event_type"))


def _reference_job(root):
    return {
        "spark": {"app-name": "Kafka to table", "enable-hive": False, "trigger-interval": "1 minute",
                  "checkpoint-location": f"{root}/ckpt"},
        "kafka": {"bootstrap-servers": "localhost:9092", "topic": "events", "group-id": "g1",
                  "starting-offsets": "earliest", "security-protocol": "PLAINTEXT"},
        "application": {
            "hive-database": "db", "hive-table": "t", "output-path": f"{root}/target",
            "partition-column": "audit_load_date", "date-format": "yyyy-MM-dd", "primary-keys": ["event_id"],
            "dedup-lookback-days": 2, "custom-transformer-class": "", "custom-flatten-class": "",
            "extra-params": {"threshold": "1000"},
            "json": {"groups": CONFIG["json"]["groups"],
                     "type-overrides": CONFIG["json"]["type_overrides"]}},
        "filter": {"rules": [{"field": "event_type", "operator": "not_equals", "value": "error"}]},
        "error": {"error-path": f"{root}/errors", "enable-error-capture": True},
    }


def test_reference_layout_translation():
    job = _reference_job("/r")
    assert app.is_reference_layout(job)
    cfg = app.from_reference_layout(job)
    spec = app.build_spec(cfg)
    assert spec.target.path == "/r/target" and spec.error_path == "/r/errors" and spec.lookback_days == 2
    assert [m.type for m in spec.mappings if m.name in ("user_id", "value", "k")] == ["long", "double", "int"]
    assert spec.rules[0].operator == "not_equals" and spec.params == {"threshold": "1000"}
    assert cfg["source"] == {"format": "kafka", "topic": "events", "bootstrap_servers": "localhost:9092",
                             "starting_offsets": "earliest", "security_protocol": "PLAINTEXT", "group_id": "g1"}
    assert cfg["stream"] == {"checkpoint": "/r/ckpt", "trigger": {"processingTime": "1 minute"}}
    hive = dict(job, spark=dict(job["spark"], **{"enable-hive": True}))
    assert app.build_spec(app.from_reference_layout(hive)).target.table == "db.t"


def test_reference_layout_job_runs_with_a_named_transformer(spark, workdir):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    write_replay(messages_from_events(events), f"{workdir}/replay", files=2)
    job = _reference_job(f"{workdir}/ref")
    job["application"]["custom-transformer-class"] = "test_app:tag_kind"
    job["source"] = {"format": "replay", "path": f"{workdir}/replay"}
    job["stream"] = {"trigger": {"availableNow": True}}
    q = app.run_app(spark, job, on_metrics=None)
    q.awaitTermination()
    assert q.exception() is None
    kinds = {r[0] for r in read_rows(spark, f"{workdir}/ref/target").select("event_type").distinct().collect()}
    assert kinds and all(k == k.upper() for k in kinds)
    with pytest.raises(SpecError):
        app.load_callable("no_colon_here")
