"""A bucketed index of the stored keys for the anti join (JN-1, FLT-10).

The lookback of a large target holds far more keys than a batch.  Kept as a table of keys that is bucketed by them, it is
dealt for the join once, when a key is stored, and not again with every batch: the anti join shuffles the batch's side only,
into as many partitions as there are buckets, and reads the buckets as they lie.  No size of either side makes it fall back
to a shuffle of the stored side, and nothing is broadcast.

The index follows the target: a batch appends its rows first and its keys after.  If a driver stops between the two, the
index lacks keys of stored rows; so a batch that may have begun before (the first of a start, or one that the ledger knows)
is compared with the target itself, and then adds whichever of its keys the index lacks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import any_null, ident
from ..spec import SpecError


def create_key_index(spark: SparkSession, table: str, schema: T.StructType, keys: Sequence[str], partition_column: str, *,
                     buckets: int = 200, path: str | None = None) -> None:
    """An empty Parquet table of the key columns, in a folder per load date, bucketed and sorted by the keys.

    ``buckets`` fixes how many tasks the join has; choose it so that a bucket of the whole lookback fits one task.
    """
    fields = [T.StructField(k, schema[k].dataType) for k in keys] + [T.StructField(partition_column, T.StringType())]
    w = spark.createDataFrame([], T.StructType(fields)).write.format("parquet").partitionBy(partition_column) \
        .bucketBy(buckets, *keys).sortBy(*keys)
    if path is not None:
        w = w.option("path", path)
    w.mode("errorifexists").saveAsTable(table)


def bucket_count(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Num Buckets'").select("data_type").collect()
    if not rows:
        raise SpecError(f"table {table} is not bucketed; create it with create_key_index")
    return int(rows[0][0])


def append_keys(rows: DataFrame, table: str, keys: Sequence[str], partition_column: str) -> None:
    """Add the keys of ``rows`` with their load date.

    Dealt like the buckets, so a task writes one file of one bucket, for each load date of the rows.
    """
    spark = rows.sparkSession
    out = rows.select(*[F.col(ident(k)) for k in keys], F.col(ident(partition_column))).filter(~any_null(list(keys)))
    dealt = out.repartition(bucket_count(spark, table), *[F.col(ident(k)) for k in keys]).sortWithinPartitions(
        F.col(ident(partition_column)), *[F.col(ident(k)) for k in keys])
    dealt.write.insertInto(table)


def indexed_keys(spark: SparkSession, table: str, keys: Sequence[str], partition_column: str,
                 dates: Sequence[str] | None = None) -> DataFrame:
    """The indexed keys of the given load dates (all without), as the buckets lie: no expression hides the columns."""
    if not spark.catalog.tableExists(table):
        raise SpecError(f"key index {table} does not exist; build it from the target first (build_key_index)")
    stored = spark.table(table)
    if dates is not None:
        stored = stored.filter(F.col(ident(partition_column)).isin(*dates))
    return stored.select(*[F.col(ident(k)) for k in keys])


def build_key_index(spark: SparkSession, table: str, target: DataFrame | None, schema: T.StructType, keys: Sequence[str],
                    partition_column: str, *, buckets: int = 200, path: str | None = None) -> None:
    """Create the index and fill it with the distinct keys of the target's rows (None: no target yet)."""
    create_key_index(spark, table, schema if target is None else target.schema, keys, partition_column, buckets=buckets, path=path)
    if target is not None:
        columns = [F.col(ident(c)) for c in (*keys, partition_column)]
        append_keys(target.select(*columns).distinct(), table, keys, partition_column)
