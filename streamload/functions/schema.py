"""Nested parse schema from dotted field paths (PRJ-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from ..spec import FieldMapping, check_mappings
from .types import resolve_type


def schema_from_mappings(mappings: Sequence[FieldMapping], on_unknown: str = "error") -> T.StructType:
    """Build the ``from_json`` schema that holds exactly the mapped paths.

    Paths are split on ``.``; siblings are grouped under their common head
    in first-appearance order; every field is nullable.  Only mapped paths
    are parsed, so the rest of each document is skipped by the parser.
    """
    check_mappings(mappings)
    root: dict = {}
    for m in mappings:
        node = root
        parts = m.parts()
        for p in parts[:-1]:
            node = node.setdefault(p, {})
        node[parts[-1]] = resolve_type(m.type, on_unknown)

    def build(node: dict) -> T.StructType:
        return T.StructType([
            T.StructField(k, build(v) if isinstance(v, dict) else v, True) for k, v in node.items()
        ])

    return build(root)
