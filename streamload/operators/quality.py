"""Bad-record split and error rows (FLT-8, FLT-9, PRJ-11, PRJ-12, SET-1, AGG-5).

Rows are tagged with an ``error_reason`` once; good and bad are two filters
of the same (persisted) frame, so nothing is parsed twice and no union is
needed unless hooks changed the columns in between.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import any_null, as_of_lit, quote_path
from ..spec import JSON_PARSE_FAILURE, NULL_PRIMARY_KEY
from .parse import ENVELOPE, PARSE_FAILED, SOURCE_STRUCT

ERROR_REASON = "error_reason"
#: Where a rebuilt error row came from, beside its rebuilt envelope (topic, partition, offset of the message).
IDENTITY = ("src_topic", "src_partition", "src_offset")


def error_columns(partition_column: str) -> list[str]:
    return [*ENVELOPE, ERROR_REASON, partition_column]


def reserialized_json(columns: Sequence[str]) -> Column:
    """JSON text rebuilt from flat columns; NULL fields are left out (PRJ-12)."""
    return F.to_json(F.struct(*[F.col(quote_path(c)) for c in columns]))


def error_reason(keys: Sequence[str], parse_failed: str | None = PARSE_FAILED) -> Column:
    """``JSON_PARSE_FAILURE`` / ``NULL_PRIMARY_KEY`` / NULL (good), first match wins."""
    nulls = " OR ".join(f"{quote_path(k)} IS NULL" for k in keys)
    first = "" if parse_failed is None else f"WHEN {quote_path(parse_failed)} THEN '{JSON_PARSE_FAILURE}' "
    return F.expr(f"CASE {first}WHEN {nulls} THEN '{NULL_PRIMARY_KEY}' END")


def to_error_rows(df: DataFrame, reason: Column | str, partition_column: str, *,
                  data_columns: Sequence[str] = (), topic: str = "",
                  as_of: _dt.datetime | None = None, reserialize: bool = False, identity: bool = False) -> DataFrame:
    """Project rows into the 7-column error schema.

    The original text and source position come from the ``_src`` struct.  If
    a hook dropped it, or ``reserialize`` is asked for, the reference's
    fallback is used: JSON rebuilt from ``data_columns``, the configured
    topic, partition/offset -1 and the batch clock as timestamp.

    With ``identity`` the position of the message is kept in three more columns
    (``IDENTITY``), so a rebuilt row can still be told from others of the same
    text; they are NULL where a hook dropped ``_src``.
    """
    reason_col = F.lit(reason) if isinstance(reason, str) else reason
    ids = []
    if identity:
        known = SOURCE_STRUCT in df.columns
        ids = [F.expr(f"CAST({f'{SOURCE_STRUCT}.{c}' if known else 'NULL'} AS {kind}) AS {name}")
               for name, c, kind in zip(IDENTITY, ("topic", "kafka_partition", "kafka_offset"), ("STRING", "INT", "BIGINT"))]
    if SOURCE_STRUCT in df.columns and not reserialize:
        env = [F.expr(f"{SOURCE_STRUCT}.{c} AS {c}") for c in ENVELOPE]
    else:
        ts = as_of_lit(as_of).cast("timestamp") if as_of is not None else F.current_timestamp()
        env = [
            reserialized_json(data_columns).alias("json_raw"),
            F.lit(topic).alias("topic"),
            F.lit(-1).alias("kafka_partition"),
            F.lit(-1).cast("long").alias("kafka_offset"),
            ts.alias("kafka_timestamp"),
        ]
    return df.select(*env, reason_col.alias(ERROR_REASON), *ids, F.col(quote_path(partition_column)))


def split_bad_records(tagged: DataFrame, partition_column: str, *, reason_column: str = ERROR_REASON,
                      data_columns: Sequence[str] = (), topic: str = "",
                      as_of: _dt.datetime | None = None, reserialize: bool = False
                      ) -> tuple[DataFrame, DataFrame]:
    """Split a frame tagged by :func:`error_reason` into (good, bad).

    Good keeps every column but the tag and ``parse_failed``; bad is in the
    error schema.  Parse failures always keep their original envelope.  With
    ``reserialize`` bad also has the ``IDENTITY`` columns.
    """
    reason = F.col(reason_column)
    drop = [c for c in (reason_column, PARSE_FAILED) if c in tagged.columns]
    good = tagged.filter(reason.isNull()).drop(*drop)
    bad_rows = tagged.filter(reason.isNotNull())
    if reserialize and SOURCE_STRUCT in tagged.columns:
        # Parse failures keep their text; only null-key rows are rebuilt.
        parse_bad = bad_rows.filter(reason == JSON_PARSE_FAILURE)
        key_bad = bad_rows.filter(reason != JSON_PARSE_FAILURE)
        bad = to_error_rows(parse_bad, reason, partition_column, identity=True).unionByName(
            to_error_rows(key_bad, reason, partition_column, data_columns=data_columns, topic=topic,
                          as_of=as_of, reserialize=True, identity=True))
    else:
        bad = to_error_rows(bad_rows, reason, partition_column, data_columns=data_columns, topic=topic,
                            as_of=as_of, identity=reserialize)
    return good, bad


def error_summary(errors: DataFrame, partition_column: str = "audit_load_date") -> DataFrame:
    """Error counts by reason and load date (AGG-5); partial aggregation map-side."""
    return errors.groupBy(ERROR_REASON, partition_column).agg(F.count(F.lit(1)).alias("n_errors"))
