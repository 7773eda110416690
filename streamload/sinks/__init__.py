"""Sinks: partitioned Parquet, catalog tables, error and audit datasets."""

from .files import append_parquet, append_table, create_target_table, size_files

__all__ = ["append_parquet", "append_table", "create_target_table", "size_files"]
