"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamload.workspace import fresh_dir

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return:
#: exactly what bytes.split() separates, and what this regular expression splits on in the JVM.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(docs: DataFrame) -> Column:
    """The text column, null as the empty text."""
    return F.coalesce(docs["text"], F.lit(""))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the session's shared folder and read it back.

    Cuts the lineage with files that every executor can read, so that a lost executor costs
    neither the result nor a second run of what came before.
    """
    path = fresh_dir(df.sparkSession, name) + "/data"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``fn`` over each Arrow batch of ``df``; None gives no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None and out.num_rows:
                yield out
    return df.mapInArrow(run, schema)


# --------------------------------------------------------------------------- 64-bit mixing (numpy)

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An order-sensitive hash of two 64-bit hashes."""
    return mix(mix(a) ^ (b * _GOLD + np.uint64(1)))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def merged(starts: np.ndarray, width: int, limit: int) -> list[tuple[int, int]]:
    """Maximal runs covered by ``[s, s + width)`` for sorted starts, cut at ``limit``."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > width) + 1
    first = starts[np.concatenate(([0], cut))]
    last = starts[np.concatenate((cut - 1, [len(starts) - 1]))] + width
    return [(int(a), int(min(b, limit))) for a, b in zip(first, last)]
