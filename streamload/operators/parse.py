"""Envelope projection, JSON parsing and flattening (PRJ-1 … PRJ-9).

All of it is one narrow, row-local projection: no shuffle, runs inside the
source stage, scales with the number of input partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ident, path_col, quote_path
from ..functions.schema import schema_from_mappings
from ..functions.types import resolve_type
from ..spec import FieldMapping

# Envelope column names (after projection) and the struct that
# carries them through flattening and hooks.
ENVELOPE = ("json_raw", "topic", "kafka_partition", "kafka_offset", "kafka_timestamp")
SOURCE_STRUCT = "_src"
PARSED = "parsed"
PARSE_FAILED = "parse_failed"
CORRUPT_FIELD = "_corrupt_record"


def project_envelope(df: DataFrame) -> DataFrame:
    """Kafka source row -> ``json_raw topic kafka_partition kafka_offset kafka_timestamp``.

    Accepts the raw Kafka column set (``value`` BINARY …) or an already
    projected frame (then it is returned unchanged apart from column order).
    """
    cols = set(df.columns)
    if set(ENVELOPE) <= cols:
        return df.select(*ENVELOPE)
    return df.selectExpr(
        "CAST(`value` AS STRING) AS json_raw",
        "CAST(`topic` AS STRING) AS topic",
        "CAST(`partition` AS INT) AS kafka_partition",
        "CAST(`offset` AS BIGINT) AS kafka_offset",
        "CAST(`timestamp` AS TIMESTAMP) AS kafka_timestamp",
    )


def parse_json_records(df: DataFrame, schema: T.StructType | str, *, column: str = "json_raw",
                       strict: bool = True, on_type_mismatch: str = "keep") -> DataFrame:
    """Add ``parsed`` (struct per ``schema``) and ``parse_failed`` (boolean).

    ``strict`` fails a row unless its text is one complete JSON object and nothing else.  ``from_json`` keeps whatever
    leaves it could read and stops after the first value, so its result alone tells neither.  One parse tells both
    (:func:`parse_enclosed`).  A mistyped leaf (``"amt":"oops"``, an overflow, a scalar where an object is mapped) is NULL
    in a good row.

    ``on_type_mismatch="error"`` is the documented reading of "does not match the configured schema": a mistyped leaf fails
    the row too.  The parser says so only by the text it records as corrupt, which it does for a struct alone, so this
    mode looks at the text again (:func:`one_value`).  Its failures are a superset of the strict rule's.

    ``strict=False`` is the reference's rule: only a NULL struct (NULL, empty, blank text) fails.
    """
    if on_type_mismatch not in ("keep", "error"):
        raise ValueError("on_type_mismatch must be 'keep' or 'error'")
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    if CORRUPT_FIELD in schema.fieldNames():
        raise ValueError(f"{CORRUPT_FIELD!r} is reserved")
    if strict and on_type_mismatch == "keep":
        return parse_enclosed(df, schema, column)
    with_bad = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_FIELD, T.StringType(), True)])
    parsed = F.from_json(F.col(column), with_bad, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_FIELD})
    out = df.withColumn(PARSED, parsed)
    failed = F.col(PARSED).isNull()
    if on_type_mismatch == "error":
        failed = failed | F.col(f"{PARSED}.{CORRUPT_FIELD}").isNotNull() | ~one_value(column)
    return out.withColumn(PARSE_FAILED, F.coalesce(failed, F.lit(True)))


#: The field of the object put after each text; no message can know the name, it is another one in every process.
END_FIELD = f"_end_{uuid.uuid4().hex}"


def parse_enclosed(df: DataFrame, schema: T.StructType, column: str = "json_raw") -> DataFrame:
    """Parse each text and see in the same pass whether it is one complete object.

    The text is read as the first of two elements of an array whose second one is ours: ``[text,{"_end_…":1}]``.  Text that
    stops early, goes on after its object or holds several gives no array, or not these two elements; text that closes the
    array itself hides the second one.  A mistyped leaf leaves the other elements as they are.
    """
    item = T.StructType(list(schema.fields) + [T.StructField(END_FIELD, T.IntegerType(), True)])
    text = F.concat(F.lit("["), F.col(column), F.lit(f',{{"{END_FIELD}":1}}]'))
    items = "_items"
    while items in df.columns:
        items = "_" + items
    out = df.withColumn(items, F.from_json(text, T.ArrayType(item)))
    first, last = F.get(items, F.lit(0)), F.get(items, F.lit(1))
    whole = (F.size(items) == 2) & first.isNotNull() & first[END_FIELD].isNull() & (last[END_FIELD] == 1)
    return out.withColumns({PARSED: first.dropFields(END_FIELD), PARSE_FAILED: ~F.coalesce(whole, F.lit(False))}).drop(items)


def one_value(column: str) -> Column:
    """Whether the text is one JSON value and nothing else.

    The parsers stop after the first value, so the text is looked at inside
    an array, which must have one element.  Text that closes that array itself
    (``{…}]``) is caught inside an object; only text with a ``]`` is looked at twice.
    """
    text = quote_path(column)
    return F.expr(f"coalesce(json_array_length(concat('[', {text}, ']')) = 1, false) AND (NOT contains({text}, ']') "
                  f"OR json_object_keys(concat('{{\"x\":', {text}, '}}')) IS NOT NULL)")


# A JSON text that parses and starts with "{" (after JSON
# whitespace) is one object.
OBJECT_START = r"^[ \t\r\n]*\{"


def parse_variant_records(df: DataFrame, *, column: str = "json_raw") -> DataFrame:
    """Add ``parsed`` as a VARIANT holding the whole document, and ``parse_failed``.

    For flatteners that need fields the mapping does not name (no schema has
    to be declared).  ``try_parse_json`` gives NULL for text that is not
    JSON; valid JSON that does not start with ``{`` is not an object.  Unlike
    ``from_json`` it rejects duplicate keys and single quotes.
    """
    parsed = F.try_parse_json(F.col(column))
    failed = parsed.isNull() | ~F.col(column).rlike(OBJECT_START) | ~one_value(column)
    return df.withColumn(PARSED, parsed).withColumn(PARSE_FAILED, F.coalesce(failed, F.lit(True)))


def flatten_columns(mappings: Sequence[FieldMapping], root: str = PARSED,
                    on_unknown: str = "error") -> list[Column]:
    """One typed column per mapping from the parsed struct (PRJ-5).

    Atomic target types are written as one SQL expression each (one call to
    the JVM instead of three per column, which adds up per micro-batch);
    nested types use the Column API.
    """
    out = []
    for m in mappings:
        dtype = resolve_type(m.type, on_unknown)
        if isinstance(dtype, T.AtomicType):
            out.append(F.expr(f"CAST({quote_path(f'{root}.{m.path}')} AS {dtype.simpleString()}) AS {ident(m.name)}"))
        else:
            out.append(path_col(m.path, root).cast(dtype).alias(m.name))
    return out


def flatten(df: DataFrame, mappings: Sequence[FieldMapping], *, keep: Sequence[str] = (),
            on_unknown: str = "error") -> DataFrame:
    """Parsed rows -> flat rows: mapped columns in mapping order (+ ``keep``).

    A single ``select`` (PRJ-9 pruning included), so a target name can never
    shadow ``parsed`` or the envelope midway through.
    """
    return df.select(*flatten_columns(mappings, on_unknown=on_unknown), *[F.col(quote_path(k)) for k in keep])


def source_struct() -> Column:
    """The envelope packed into one struct column that rides along with rows."""
    return F.expr(f"struct({', '.join(ENVELOPE)}) AS {SOURCE_STRUCT}")


def parse_messages(df: DataFrame, mappings: Sequence[FieldMapping], *, strict: bool = True,
                   on_unknown: str = "error", schema: T.StructType | None = None,
                   on_type_mismatch: str = "keep", variant: bool = False) -> DataFrame:
    """Envelope + parse in one go: ``_src`` struct, ``parsed``, ``parse_failed``.

    ``schema`` replaces the mapping-derived parse schema (e.g. the whole
    document for a custom flattener); ``variant`` parses the whole document
    into a VARIANT instead.
    """
    env = project_envelope(df)
    if variant:
        return parse_variant_records(env).select(source_struct(), F.col(PARSED), F.col(PARSE_FAILED))
    schema = schema or schema_from_mappings(mappings, on_unknown)
    return parse_json_records(env, schema, strict=strict, on_type_mismatch=on_type_mismatch).select(
        source_struct(), F.col(PARSED).dropFields(CORRUPT_FIELD).alias(PARSED), F.col(PARSE_FAILED))


def flattener_input(parsed: DataFrame) -> DataFrame:
    """What a custom flattener sees: the envelope columns, ``parsed`` and ``_src``."""
    return parsed.selectExpr(*[f"{SOURCE_STRUCT}.{c} AS {c}" for c in ENVELOPE], PARSED, SOURCE_STRUCT)


def with_load_date(df: DataFrame, column: str = "audit_load_date", fmt: str = "yyyy-MM-dd",
                   as_of=None) -> DataFrame:
    """Append the load-date partition column, fixed for the batch (PRJ-10)."""
    from ..functions.columns import load_date, resolve_as_of
    return df.withColumn(column, load_date(resolve_as_of(as_of), fmt))
