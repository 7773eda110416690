"""Declarative filter rules (FLT-1 … FLT-7).

Each rule becomes one Column predicate; all rules are AND-ed into a single
``filter`` that Catalyst pushes as far down as it can.  Rule literals are
cast to the column's type when the condition is built, by Spark's own
``try_cast``, so ``"30"`` matches an INT 30 whether ANSI mode is on or off,
and a literal for which that gives NULL is a spec error instead of a rule that
matches nothing (or, negated, drops every row).
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import constants, quote_path
from ..spec import RULE_OPERATORS, FilterRule, SpecError


def _field_type(schema: T.StructType | None, field: str) -> T.DataType | None:
    if schema is None:
        return None
    node: T.DataType = schema
    for part in field.split("."):
        if not isinstance(node, T.StructType) or part not in node.fieldNames():
            raise SpecError(f"filter field {field!r} is not a column")
        node = node[part].dataType
    return node


@functools.lru_cache(maxsize=1024)
def _castable(literals: tuple[tuple[str, str], ...]) -> tuple[bool, ...]:
    """Whether Spark's ``try_cast`` of each (text, type) gives a value; one constant row, no job."""
    return constants(*[F.lit(text).try_cast(dtype).isNotNull() for text, dtype in literals])


def _texts(values, dtype: T.DataType, rule: FilterRule) -> list[str]:
    """The literals of a rule as text, all of them valid for the column's type."""
    if any(v is None for v in values):
        raise SpecError(f"rule {rule!r}: a NULL literal can match nothing; is_null / is_not_null test for NULL")
    texts = [str(v).lower() if isinstance(v, bool) else str(v) for v in values]
    ddl = dtype.simpleString()
    for value, ok in zip(values, _castable(tuple((t, ddl) for t in texts)) if texts else ()):
        if not ok:
            raise SpecError(f"rule {rule!r}: {value!r} does not cast to {ddl}")
    return texts


def _typed_literals(values, dtype: T.DataType | None, rule: FilterRule) -> list[Column]:
    if dtype is None or isinstance(dtype, T.StringType):
        return [F.lit(v if v is None or isinstance(v, str) else str(v)) for v in values]
    return [F.lit(t).try_cast(dtype) for t in _texts(values, dtype, rule)]


def build_condition(rule: FilterRule, schema: T.StructType | None = None) -> Column:
    """One rule -> Column.  Operator names are case-insensitive.

    ``in []`` keeps no row; ``not_in []`` keeps every row whose value is not
    NULL.  As in SQL, ``equals``/``not_equals``/``in``/``not_in`` drop rows
    whose value is NULL.
    """
    op = rule.operator.lower()
    c = F.col(quote_path(rule.field))
    dtype = _field_type(schema, rule.field)
    if op in ("equals", "not_equals"):
        if rule.value is None:
            raise SpecError(f"rule on {rule.field!r}: {op} compares with one value, set value")
        (lit,) = _typed_literals([rule.value], dtype, rule)
        return c == lit if op == "equals" else c != lit
    if op in ("in", "not_in"):
        if rule.values is None:
            raise SpecError(f"rule on {rule.field!r}: {op} compares with a list, set values (it may be empty)")
        lits = _typed_literals(rule.values, dtype, rule)
        if not lits:
            return F.lit(False) if op == "in" else c.isNotNull()
        member = c.isin(*lits)
        return member if op == "in" else ~member
    if op == "is_not_null":
        return c.isNotNull()
    if op == "is_null":
        return c.isNull()
    raise SpecError(f"rule on {rule.field!r}: {rule.operator!r} is none of {', '.join(RULE_OPERATORS)}")


def rules_condition(rules: Sequence[FilterRule], schema: T.StructType | None = None) -> Column | None:
    """AND of all rules, or None for no rules."""
    conds = [build_condition(r, schema) for r in rules]
    return reduce(lambda a, b: a & b, conds) if conds else None


def apply_rules(df: DataFrame, rules: Sequence[FilterRule]) -> DataFrame:
    """Keep rows satisfying every rule (FLT-7); no rules = identity.

    NULL results count as "not satisfied", so the kept set is exactly the
    rows where the conjunction is TRUE.
    """
    cond = rules_condition(rules, df.schema)
    return df if cond is None else df.filter(cond)
