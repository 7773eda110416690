"""User hooks: custom transformer and custom flattener (EXT-1 … EXT-4).

Hooks are ordinary Python callables from DataFrame to DataFrame; they are
called once per batch on the driver to *build* the plan, never per row.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import quote_path, variant_path
from ..spec import SpecError


class ContractError(SpecError):
    """A hook returned a frame that the rest of the pipeline cannot use."""


def check_contract(df: DataFrame, keys: Sequence[str], expected: Sequence[str] = (), *,
                   hook: str = "hook", reserved: Sequence[str] = ()) -> None:
    """Driver-side column check of a hook's output (no job runs).

    Primary keys must be present; every other expected column that is
    missing is reported in the same error; reserved names (the partition
    column) must not be produced by the hook.
    """
    cols = set(df.columns)
    missing_keys = [k for k in keys if k not in cols]
    missing = [c for c in expected if c not in cols and c not in keys]
    clash = [c for c in reserved if c in cols]
    if missing_keys or missing or clash:
        parts = []
        if missing_keys:
            parts.append(f"gives no {', '.join(missing_keys)}, which dedup joins on")
        if missing:
            parts.append(f"gives no {', '.join(missing)}, which the mapping names")
        if clash:
            parts.append(f"gives {', '.join(clash)}, which the pipeline adds itself")
        raise ContractError(f"{hook} " + "; ".join(parts))


def _call(fn: Callable[..., DataFrame], df: DataFrame, params: Mapping[str, str]) -> DataFrame:
    try:
        n = len(inspect.signature(fn).parameters)
    except (TypeError, ValueError):
        n = 2
    return fn(df, dict(params)) if n >= 2 else fn(df)


def apply_transformer(df: DataFrame, fn: Callable[..., DataFrame], keys: Sequence[str],
                      params: Mapping[str, str] | None = None, expected: Sequence[str] = (),
                      reserved: Sequence[str] = ()) -> DataFrame:
    """Run a transformer ``fn(df)`` or ``fn(df, params)`` and check its output (EXT-1, EXT-4)."""
    out = _call(fn, df, params or {})
    check_contract(out, keys, expected, hook="custom transformer", reserved=reserved)
    return out


def apply_flattener(df: DataFrame, fn: Callable[..., DataFrame], keys: Sequence[str],
                    params: Mapping[str, str] | None = None, reserved: Sequence[str] = ()) -> DataFrame:
    """Run a flattener on ``json_raw … kafka_timestamp, parsed, _src`` (EXT-2, EXT-3).

    The flattener owns the output column list; only the keys are required.
    """
    out = _call(fn, df, params or {})
    check_contract(out, keys, hook="custom flattener", reserved=reserved)
    return out


def document_field(df: DataFrame, path: str, type_name: str, root: str = "parsed") -> Column:
    """One typed leaf of the parsed document, whether it is a struct or a VARIANT.

    A leaf of the wrong JSON type is NULL in both cases (permissive).
    """
    if isinstance(df.schema[root].dataType, T.VariantType):
        return F.try_variant_get(F.col(root), variant_path(path), type_name)
    return F.col(f"{root}." + quote_path(path)).cast(type_name)


# ---- ready-made hooks (the documented examples) ---------------------------

def mask_columns(columns: Sequence[str], mask: str = "[hidden]") -> Callable[..., DataFrame]:
    """Transformer replacing the values of ``columns`` with a constant (PII masking).

    ``params["mask"]`` overrides the mask text per pipeline.
    """
    def hook(df: DataFrame, params: Mapping[str, str]) -> DataFrame:
        text = params.get("mask", mask)
        return df.withColumns({c: F.lit(text).cast(df.schema[c].dataType) for c in columns})
    return hook


def derive_score(source: str, target: str, scores: Mapping[str, int], default: int = 1
                 ) -> Callable[..., DataFrame]:
    """Transformer adding ``target`` = CASE source WHEN k THEN v … ELSE default END."""
    def hook(df: DataFrame) -> DataFrame:
        expr = None
        for k, v in scores.items():
            cond = F.col(quote_path(source)) == F.lit(k)
            expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
        expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
        return df.withColumn(target, expr)
    return hook


def chain(*hooks: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Compose transformers left to right; each gets the params if it takes them."""
    def hook(df: DataFrame, params: Mapping[str, str]) -> DataFrame:
        for h in hooks:
            df = _call(h, df, params)
        return df
    return hook


def threshold_flattener(columns: Mapping[str, tuple[str, str]], measure: str,
                        param: str = "threshold") -> Callable[..., DataFrame]:
    """Flattener selecting ``{name: (path, type)}`` from ``parsed`` and keeping
    rows with ``measure > float(params[param])`` (the documented example).
    ``_src`` is kept so error rows still carry the original message.
    ``parsed`` may be a struct or a VARIANT (``flattener_schema="variant"``)."""
    def hook(df: DataFrame, params: Mapping[str, str]) -> DataFrame:
        limit = float(params.get(param, "0"))
        cols = [document_field(df, p, t).alias(n) for n, (p, t) in columns.items()]
        return df.select(*cols, F.col("_src")).filter(F.col(quote_path(measure)) > F.lit(limit))
    return hook
