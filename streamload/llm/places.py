"""Places of rows in the order of their group, without a task that holds a group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition with its number and their count inside their run of one group."""
    part, last, done = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        group = batch.column("__group")
        new = np.ones(n, dtype=bool)
        new[1:] = pc.not_equal(group.slice(1), group.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[0] = group[0].as_py() != last
        rows = np.arange(n, dtype=np.int64)
        start = np.maximum.accumulate(np.where(new, rows, -1))
        place = np.where(start >= 0, rows - start, rows + done)
        last, done = group[n - 1].as_py(), int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, dtype=np.int32)), pa.array(place)],
                                         names=[*batch.schema.names, "__part", "__seq"])


def with_places(rows: DataFrame, group: str, order: Sequence[str | Column], place: str, name: str) -> DataFrame:
    """``rows`` with the 0-based long ``place`` that each has in its group, in ascending order, nulls first.

    ``group`` is a column without nulls.  The rows are dealt by ranges of (group, order), so a group of any size is spread
    over many tasks; rows that are equal in all of it are dealt by where they were read.  A task counts its own rows of a
    group, and of the groups that go on from one task to another (two for a task at most, so this table is no longer than
    twice the number of tasks) the rows of earlier tasks are added.  ``rows`` should be read from files: they are read
    twice, and the second time must give the same rows.
    """
    dealt = rows.withColumn("__group", F.col(group)).withColumn("__row", F.monotonically_increasing_id())
    keys = [F.col("__group"), *[F.col(c) if isinstance(c, str) else c for c in order], F.col("__row")]
    dealt = dealt.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__row")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema) + ", __part int, __seq long"
    counted = materialize(dealt.mapInArrow(_numbered, schema), name)
    runs = counted.groupBy("__group", "__part").agg(F.count(F.lit(1)).alias("__n"))
    spread = runs.groupBy("__group").agg(F.count(F.lit(1)).alias("k"), F.collect_list(F.struct("__part", "__n")).alias("runs")) \
        .where("k > 1").select("__group", F.explode("runs").alias("r")).select("__group", "r.*")
    before = Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spread.select("__group", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return counted.join(F.broadcast(offsets), ["__group", "__part"], "left") \
        .withColumn(place, F.col("__seq") + F.coalesce("__before", F.lit(0))) \
        .drop("__group", "__part", "__seq", "__before")
