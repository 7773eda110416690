"""Sources: Kafka, Kafka-shaped replay files, the existing target, event fixtures."""

from .feed import existing_rows_from_events, messages_from_events
from .kafka import kafka_options, read_kafka, read_kafka_range
from .replay import KAFKA_SCHEMA, read_replay, read_replay_batch, write_replay
from .target import read_target

__all__ = [
    "KAFKA_SCHEMA", "existing_rows_from_events", "kafka_options", "messages_from_events", "read_kafka",
    "read_kafka_range", "read_replay", "read_replay_batch", "read_target", "write_replay",
]
