"""Type names accepted in field mappings (PRJ-4)."""

from __future__ import annotations

from pyspark.sql import types as T

from ..spec import SpecError

# The short type names of the configuration language and the
# Spark types they stand for.
TYPE_NAMES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def resolve_type(name: str | T.DataType, on_unknown: str = "error") -> T.DataType:
    """Map a configured type name to a Spark type.

    The short names above are matched case-insensitively.  Anything else is
    tried as a Spark DDL type (``decimal(12,2)``, ``array<string>``,
    ``map<string,int>`` …).  An unparseable name raises, or becomes
    ``StringType`` with ``on_unknown="string"``.
    """
    if isinstance(name, T.DataType):
        return name
    key = name.strip().lower()
    if key in TYPE_NAMES:
        return TYPE_NAMES[key]
    try:
        return T._parse_datatype_string(name.strip())
    except Exception as e:  # noqa: BLE001 - Spark raises several kinds here
        if on_unknown == "string":
            return T.StringType()
        raise SpecError(f"unknown type name {name!r}") from e
