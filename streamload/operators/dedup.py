"""Duplicate removal: in-batch and against the target (FLT-10, JN-1 … JN-4).

Scale notes
-----------
* ``dedup_within_batch`` is ``row_number() = 1`` over the keys.  Spark plans a
  partial group limit before the exchange, so a hot key that holds a third of
  the batch is cut to one row per map task before anything moves.  (It needs
  ``spark.sql.optimizer.windowGroupLimitThreshold`` of at least 1, the
  default is 1000.)
* ``anti_join_existing`` is a plain equi left-anti join on the keys.  The
  existing side is pruned to the lookback partitions and to the key
  columns at the scan (``PartitionFilters`` / ``ReadSchema``).  No broadcast
  is forced: AQE broadcasts the existing keys only when their measured size
  is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise keeps the
  sort-merge join, whose skewed left partitions AQE splits.
* ``restrict_to_keys`` is the step before it when the lookback holds far
  more keys than the batch: the batch's keys, whose size was measured, are
  broadcast and the existing keys are semi-joined against them map-side,
  so only keys that can match move to the anti join instead of the whole
  lookback window.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ident, lookback_values, quote_path
from ..spec import SpecError

ERROR_KEYS = ("topic", "kafka_partition", "kafka_offset")


def free_prefix(df: DataFrame, prefix: str) -> str:
    """A name prefix no column of ``df`` starts with, so renamed join keys resolve by name alone."""
    while any(c.startswith(prefix) for c in df.columns):
        prefix = "_" + prefix
    return prefix


def _as_col(c: str | Column) -> Column:
    return F.col(quote_path(c)) if isinstance(c, str) else c


def dedup_within_batch(df: DataFrame, keys: Sequence[str],
                       order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """Keep one row per key: the first by ``order_by`` (JN-3).

    Ties on ``order_by`` are broken by the other columns, so the result is
    deterministic.  Columns that have no order (maps, VARIANT) break ties by
    their JSON text.  Rows keep their column order.
    """
    keys = list(keys)
    others = [f for f in df.schema.fields if f.name not in keys]
    if not others:
        return df.dropDuplicates(keys)
    order = [_as_col(c) for c in order_by or []]
    order += [F.col(ident(f.name)) if _orderable(f.dataType) else F.to_json(F.struct(F.col(ident(f.name)))) for f in others]
    rank = free_prefix(df, "_rank")
    first = Window.partitionBy(*[F.col(quote_path(k)) for k in keys]).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(first)).filter(F.col(rank) == 1).drop(rank)


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def existing_keys(target: DataFrame | None, keys: Sequence[str], partition_column: str | None = None,
                  lookback_days: int | None = None, as_of: _dt.datetime | None = None,
                  date_format: str = "yyyy-MM-dd") -> DataFrame | None:
    """Key columns of target rows whose load date is within the lookback (FLT-10).

    The window is the ``lookback_days + 1`` formatted dates ending at
    ``as_of``, matched with ``isin`` so it is right for any date format and
    becomes a partition filter at the scan.  ``lookback_days=None`` means
    the whole target.  ``None`` in, ``None`` out (no target yet).
    """
    if target is None:
        return None
    if lookback_days is not None:
        if partition_column is None or as_of is None:
            raise ValueError("a lookback needs partition_column and as_of")
        dates = [F.lit(v) for v in lookback_values(as_of, lookback_days, date_format)]
        part = F.col(quote_path(partition_column))
        dtype = target.schema[partition_column].dataType.simpleString()
        if dtype != "string":
            dates = [d.cast(dtype) for d in dates]
        target = target.filter(part.isin(*dates))
    return target.select(*[never_null(F.col(quote_path(k)), f"stored key {k}").alias(k) for k in keys])


def never_null(c: Column, what: str) -> Column:
    """The column, or an error at run time if it is NULL.

    Keys are never stored as NULL, so one means that a file of the window lacks the column.
    """
    return F.coalesce(c, F.raise_error(F.lit(f"{what} is NULL: a stored file lacks it, so duplicates would be missed")))


def comparable(stored: T.DataType, batch: T.DataType) -> bool:
    """Whether equality of the two key types means what it says (no text is cast to a number)."""
    numbers = (T.IntegralType, T.DecimalType)
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return stored == batch or any(isinstance(stored, k) and isinstance(batch, k) for k in (numbers, times))


def check_key_types(existing: DataFrame, df: DataFrame, keys: Sequence[str]) -> None:
    """Raise where a stored key's type cannot be compared with the batch's."""
    for k in keys:
        stored, batch = existing.schema[k].dataType, df.schema[k].dataType
        if not comparable(stored, batch):
            raise SpecError(f"key {k!r} is stored as {stored.simpleString()}, the batch has {batch.simpleString()}")


def anti_join_existing(df: DataFrame, existing: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``existing`` (JN-1); no target = passthrough (JN-2).

    Keys are AND-ed equalities.  Key columns of ``existing`` are renamed, so
    nested or odd key names and equal column names on both sides are safe.
    """
    if existing is None:
        return df
    keys = list(keys)
    p = free_prefix(df, "_k")
    right = existing.selectExpr(*[f"{quote_path(k)} AS {p}{i}" for i, k in enumerate(keys)])
    cond = F.expr(" AND ".join(f"{quote_path(k)} = {p}{i}" for i, k in enumerate(keys)))
    return df.join(right, cond, "left_anti")


def anti_join_errors(errors: DataFrame, existing_errors: DataFrame | None, identity: Sequence[str] = ERROR_KEYS) -> DataFrame:
    """Error rows whose message (topic, partition, offset) is not already stored (JN-4).

    ``identity`` names the three columns of ``errors`` that hold it: the envelope's, or beside a rebuilt envelope the
    ``IDENTITY`` columns.  ``existing_errors`` has them under the envelope's names.

    Rows without a source position are never matched (two messages of one text are two errors), so they bypass the join:
    all of them share one key, and a batch where a third of the messages lost their envelope would otherwise send that
    third to a single join task.
    """
    if existing_errors is None:
        return errors
    positioned = F.coalesce(F.col(identity[2]) >= 0, F.lit(False))
    # distinct: many stored copies of one position would meet in one join task
    known = existing_errors.filter(F.col(ERROR_KEYS[2]) >= 0).select(
        *[F.col(k).alias(i) for k, i in zip(ERROR_KEYS, identity)]).distinct()
    return anti_join_existing(errors.filter(positioned), known, identity).unionByName(errors.filter(~positioned))


def restrict_to_keys(existing: DataFrame | None, candidates: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Existing keys that also occur in ``candidates`` (broadcast left-semi join).

    Only call this with ``candidates`` of a measured, bounded size (see
    :func:`streamload.plans.batch.batch_stats`): they are broadcast to every
    task of the existing-keys scan.  The result is a superset of what an
    anti join against the batch can match, so following it with
    :func:`anti_join_existing` gives exactly the same rows while the large
    side is never shuffled.
    """
    if existing is None:
        return None
    keys = list(keys)
    p = free_prefix(existing, "_c")
    right = candidates.selectExpr(*[f"{quote_path(k)} AS {p}{i}" for i, k in enumerate(keys)])
    cond = F.expr(" AND ".join(f"{quote_path(k)} = {p}{i}" for i, k in enumerate(keys)))
    return existing.join(F.broadcast(right), cond, "left_semi")
