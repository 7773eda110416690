"""Appends to partitioned Parquet and to catalog tables (SNK-1 … SNK-6, PRJ-13).

Small files are controlled with a ``rebalance`` hint instead of
``coalesce(1)``: ``coalesce`` is narrow, so it would pull the parse, filter
and join of a whole batch into a single task.  A rebalance adds one shuffle
whose output AQE splits or merges to the advisory partition size, so a
batch writes a few right-sized files and the work before it stays parallel.
Writes go through Spark's commit protocol: a lost executor's tasks are
re-run and only committed files become visible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.columns import quote_path


def size_files(df: DataFrame, files: int | None = None, rebalance: bool = True) -> DataFrame:
    """Rebalance before a write: AQE-sized (``None``) or a fixed file count.

    ``rebalance=False`` leaves the partitioning as it is.  That is right when
    the plan already ends in a shuffle that AQE sizes, e.g. the in-batch
    dedup aggregate: a second exchange would move every written row again
    for the same file sizes.  A fixed ``files`` count always rebalances.
    """
    if files is not None:
        return df.hint("rebalance", int(files))
    return df.hint("rebalance") if rebalance else df


def append_parquet(df: DataFrame, path: str, partition_column: str | Sequence[str] | None, *,
                   files: int | None = None, max_records_per_file: int | None = None,
                   rebalance: bool = True) -> None:
    """Append rows to a (load-date) partitioned Parquet directory (SNK-1, SNK-3)."""
    w = size_files(df, files, rebalance).write.mode("append").format("parquet")
    if partition_column:
        parts = [partition_column] if isinstance(partition_column, str) else list(partition_column)
        w = w.partitionBy(*parts)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.save(path)


def append_table(df: DataFrame, table: str, *, files: int | None = None,
                 max_records_per_file: int | None = None, rebalance: bool = True,
                 extra_columns: str = "raise") -> None:
    """Append to an existing catalog table, matching columns **by name** (SNK-2, PRJ-13).

    The column list comes from the table itself, so columns a hook added are
    kept when the table has them; a missing one is an error, and so is one
    that the table lacks unless ``extra_columns="drop"``.  The positional
    insert then gets the table's order (partition column last).
    """
    spark = df.sparkSession
    cols = spark.table(table).columns
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"rows for {table} lack column(s) {missing}")
    extra = [c for c in df.columns if c not in cols]
    if extra and extra_columns != "drop":
        raise ValueError(f"table {table} lacks column(s) {extra}; extra_columns='drop' leaves them out")
    out = size_files(df.select(*[quote_path(c) for c in cols]), files, rebalance)
    w = out.write
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.insertInto(table)


def create_target_table(spark: SparkSession, table: str, schema: T.StructType, partition_column: str, *,
                        path: str | None = None, if_not_exists: bool = True) -> None:
    """Create a Parquet table: data columns, then the STRING partition column (SNK-6).

    ``path`` makes it an external table at that location.
    """
    if if_not_exists and spark.catalog.tableExists(table):
        return
    fields = [f for f in schema.fields if f.name != partition_column]
    full = T.StructType(fields + [T.StructField(partition_column, T.StringType(), True)])
    w = spark.createDataFrame([], full).write.format("parquet").partitionBy(partition_column)
    if path is not None:
        w = w.option("path", path)
    w.mode("errorifexists").saveAsTable(table)
