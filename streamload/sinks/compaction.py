"""Compaction of small append-only datasets: the audit and the ledger get a file per batch, for ever (AUD-1, AUD-2).

A run of :func:`compact` rewrites the closed folders of such a dataset into one file each, in a version of its own under
``_compacted``, and then makes that version the current one with one row in ``_pointer``.  Readers take the current version
and the rows that have been appended since (:func:`dataset_folders`); rows that are in both are equal, and the datasets'
readers keep one row per key anyway.  So a reader sees the rows of before or of after, and they are the same rows.

What a version has merged is deleted by the next run, not by its own: a reader that listed the files before the swap has
until then to read them.  Spark ignores folders that begin with an underscore, so a plain read of the dataset still works; it
sees what is not yet deleted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.target import path_exists, read_target

POINTER = T.StructType([T.StructField("version", T.LongType()), T.StructField("recorded_at", T.TimestampType())])
MERGED = T.StructType([T.StructField("file", T.StringType())])


def current_version(spark: SparkSession, path: str) -> int | None:
    pointer = read_target(spark, f"{path.rstrip('/')}/_pointer", schema=POINTER)
    return None if pointer is None else pointer.agg(F.max("version")).collect()[0][0]


def _version(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/_compacted/v{version}"


def dataset_folders(spark: SparkSession, path: str) -> list[str]:
    """Where the rows are: the folder of the current version, and the dataset's own with what has been appended since.

    The pointer is read first.  A row may be in both while its file waits to be deleted.
    """
    version = current_version(spark, path)
    return [path] if version is None else [f"{_version(path, version)}/rows", path]


def compact(spark: SparkSession, path: str, schema: T.StructType, partitions: Sequence[str], closed: Column) -> int | None:
    """Make a new current version that also has the rows in ``closed`` folders; returns the version, None before the first.

    ``closed`` is a condition on the partition columns.  Rows that arrive in a closed folder later are merged by the next
    run.  One compaction of a dataset runs at a time; appends and readers may run meanwhile.
    """
    old = current_version(spark, path)
    if old is not None:
        merged = read_target(spark, f"{_version(path, old)}/merged", schema=MERGED)
        _delete(spark, [r["file"] for r in merged.collect()])  # a name per batch since the run before
    loose = read_target(spark, path, schema=schema)
    if loose is None:
        return old
    rows = loose.filter(closed).withColumn("_file", F.col("_metadata.file_path"))
    names = [r["_file"] for r in rows.select("_file").distinct().collect()]
    if not names:
        return old
    new = 1 if old is None else old + 1
    while path_exists(spark, _version(path, new)):  # left by a run that stopped before its swap
        new += 1
    packed = rows.select(*schema.fieldNames())
    if old is not None:
        packed = spark.read.schema(schema).parquet(f"{_version(path, old)}/rows").unionByName(packed)
    packed.repartition(*partitions).write.partitionBy(*partitions).parquet(f"{_version(path, new)}/rows")
    spark.createDataFrame([(n,) for n in names], MERGED).coalesce(1).write.parquet(f"{_version(path, new)}/merged")
    spark.range(1).select(F.lit(new).cast("long").alias("version"), F.current_timestamp().alias("recorded_at")).coalesce(1) \
        .write.mode("append").parquet(f"{path.rstrip('/')}/_pointer")
    if old is not None and old > 1:
        _delete(spark, [_version(path, old - 1)])
    return new


def _delete(spark: SparkSession, paths: Sequence[str]) -> None:
    """Remove files or folders with the file system's own client, the one that Spark writes with."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(conf).delete(at, True)
