"""streamload — load streams of nested JSON messages into partitioned tables, on Spark.

Every step is a function from DataFrame to DataFrame; ``process_batch``
composes them for one (micro-)batch and ``run_stream`` runs that inside
Structured Streaming's ``foreachBatch``.
"""

from .spec import (JSON_PARSE_FAILURE, NULL_PRIMARY_KEY, FieldMapping, FilterRule, PipelineSpec, SpecError,
                   Target, mappings_from_fields, mappings_from_groups)
from .plans.batch import BatchMetrics, process_batch, run_batch, transform_batch
from .streaming.runner import make_batch_processor, run_stream

__all__ = [
    "JSON_PARSE_FAILURE", "NULL_PRIMARY_KEY", "BatchMetrics", "FieldMapping", "FilterRule", "PipelineSpec",
    "SpecError", "Target", "make_batch_processor", "mappings_from_fields", "mappings_from_groups",
    "process_batch", "run_batch", "run_stream", "transform_batch",
]
