"""Kafka source (SRC-1 … SRC-3, STR-5, STR-9).

The Kafka connector jar is not bundled; these functions only build the
reader.  ``kafka_options`` is pure Python and unit-tested.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# TLS settings passed through only for SSL protocols.
SSL_KEYS = (
    "kafka.ssl.truststore.location", "kafka.ssl.truststore.password",
    "kafka.ssl.keystore.location", "kafka.ssl.keystore.password", "kafka.ssl.key.password",
)


def kafka_options(topic: str, bootstrap_servers: str, *, starting_offsets: str = "earliest",
                  group_id: str | None = None, security_protocol: str = "PLAINTEXT",
                  ssl: Mapping[str, str] | None = None, max_offsets_per_trigger: int | None = None,
                  fail_on_data_loss: bool = True, min_partitions: int | None = None,
                  options: Mapping[str, str] | None = None) -> dict[str, str]:
    """Reader options for one topic.

    TLS keys are applied only when the protocol name contains ``SSL``
    (so ``SASL_SSL`` too); secrets come from the caller, never from the
    spec.  ``fail_on_data_loss`` defaults to true: losing data must be a
    choice.  ``starting_offsets`` is ``earliest``/``latest`` or the JSON
    built by :func:`streamload.operators.audit.starting_offsets_json`.
    ``min_partitions`` (Kafka's ``minPartitions``) splits large offset
    ranges into several Spark tasks, so a topic partition that carries a
    third of the traffic is parsed by many tasks instead of one.
    """
    o = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(bool(fail_on_data_loss)).lower(),
        "kafka.security.protocol": security_protocol,
    }
    if group_id:
        o["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        o["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if min_partitions:
        o["minPartitions"] = str(int(min_partitions))
    if "SSL" in security_protocol.upper():
        for k, v in (ssl or {}).items():
            key = k if k.startswith("kafka.") else f"kafka.ssl.{k}" if not k.startswith("ssl.") else f"kafka.{k}"
            if key not in SSL_KEYS:
                raise ValueError(f"unknown TLS option {k!r}")
            o[key] = v
    o.update(options or {})
    return o


def _default_min_partitions(spark: SparkSession, kw: dict) -> None:
    # One task per topic partition would leave a hot partition to a single
    # task; by default ask for at least one task per core of the cluster.
    if "min_partitions" not in kw:
        kw["min_partitions"] = spark.sparkContext.defaultParallelism


def read_kafka(spark: SparkSession, topic: str, bootstrap_servers: str, **kw) -> DataFrame:
    """Streaming DataFrame over one topic (needs the Kafka connector on the classpath).

    ``min_partitions`` defaults to the session's default parallelism; pass
    ``None`` for Kafka's one task per topic partition.
    """
    _default_min_partitions(spark, kw)
    return spark.readStream.format("kafka").options(**kafka_options(topic, bootstrap_servers, **kw)).load()


def read_kafka_range(spark: SparkSession, topic: str, bootstrap_servers: str, *,
                     ending_offsets: str = "latest", **kw) -> DataFrame:
    """Bounded read of a topic for backfill / replay (PIP-3)."""
    kw.pop("max_offsets_per_trigger", None)
    _default_min_partitions(spark, kw)
    opts = kafka_options(topic, bootstrap_servers, **kw)
    opts["endingOffsets"] = ending_offsets
    return spark.read.format("kafka").options(**opts).load()
