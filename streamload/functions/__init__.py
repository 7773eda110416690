"""Driver-side helpers that produce Spark types and Column expressions."""

from .columns import any_null, as_of_lit, load_date, lookback_dates, path_col, quote_path, resolve_as_of
from .schema import schema_from_mappings
from .types import TYPE_NAMES, resolve_type

__all__ = [
    "TYPE_NAMES", "any_null", "as_of_lit", "load_date", "lookback_dates", "path_col", "quote_path",
    "resolve_as_of", "resolve_type", "schema_from_mappings",
]
