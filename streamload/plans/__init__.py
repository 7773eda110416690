"""Compositions of the operators into batch plans."""

from .batch import (BatchMetrics, BatchResult, dedup_against_target, error_rows_plan, good_rows_plan,
                    parse_batch, process_batch, run_batch, transform_batch)

__all__ = [
    "BatchMetrics", "BatchResult", "dedup_against_target", "error_rows_plan", "good_rows_plan", "parse_batch",
    "process_batch", "run_batch", "transform_batch",
]
