import pytest

from streamload.sources import kafka_options


def test_plaintext_has_no_tls_keys():
    o = kafka_options("t", "h:9092", ssl={"truststore.location": "/x"})
    assert o["subscribe"] == "t" and o["startingOffsets"] == "earliest" and o["failOnDataLoss"] == "true"
    assert not any(k.startswith("kafka.ssl.") for k in o)


@pytest.mark.parametrize("proto", ["SSL", "sasl_ssl"])
def test_tls_keys_only_for_ssl_protocols(proto):
    o = kafka_options("t", "h", security_protocol=proto, group_id="g", max_offsets_per_trigger=100000,
                      ssl={"truststore.location": "/ts", "kafka.ssl.key.password": "p"})
    assert o["kafka.ssl.truststore.location"] == "/ts" and o["kafka.ssl.key.password"] == "p"
    assert o["kafka.group.id"] == "g" and o["maxOffsetsPerTrigger"] == "100000"


def test_unknown_tls_key_rejected():
    with pytest.raises(ValueError):
        kafka_options("t", "h", security_protocol="SSL", ssl={"truststore.colour": "x"})


def test_starting_offsets_json_passthrough_and_data_loss_choice():
    o = kafka_options("t", "h", starting_offsets='{"t":{"0":12}}', fail_on_data_loss=False)
    assert o["startingOffsets"] == '{"t":{"0":12}}' and o["failOnDataLoss"] == "false"


def test_min_partitions_splits_hot_topic_partitions():
    assert kafka_options("t", "h", min_partitions=64)["minPartitions"] == "64"
    assert "minPartitions" not in kafka_options("t", "h")


def test_reader_defaults_min_partitions_to_parallelism(spark, monkeypatch):
    from streamload.sources import kafka as K
    seen = {}

    class Reader:
        def format(self, f):
            seen["format"] = f
            return self

        def options(self, **o):
            seen.update(o)
            return self

        def load(self):
            return "df"

    class FakeSpark:
        readStream = Reader()
        read = Reader()
        sparkContext = spark.sparkContext

    assert K.read_kafka(FakeSpark(), "t", "h") == "df"
    assert seen["minPartitions"] == str(spark.sparkContext.defaultParallelism)
    seen.clear()
    K.read_kafka_range(FakeSpark(), "t", "h", min_partitions=None)
    assert "minPartitions" not in seen and seen["endingOffsets"] == "latest"
