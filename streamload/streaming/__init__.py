"""Structured Streaming entry points."""

from .monitor import ProgressTable, compact_progress, read_progress
from .progress import ProgressRecorder
from .recovery import starting_offsets_from_audit
from .runner import make_batch_processor, run_stream

__all__ = ["ProgressRecorder", "ProgressTable", "compact_progress", "read_progress", "make_batch_processor", "run_stream", "starting_offsets_from_audit"]
