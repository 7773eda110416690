"""Declarative pipeline description: field mappings, filter rules, targets.

Everything here is plain driver-side Python; nothing touches data.  A spec
is built once (from a dict, JSON or code) and validated up front so that a
mistake in the mapping fails at build time instead of inside a running
stream.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, fields, replace
from typing import Any

from pyspark.sql import DataFrame


class SpecError(ValueError):
    """A pipeline description that cannot be run."""


# Names of the error reasons written to the error dataset.
JSON_PARSE_FAILURE = "JSON_PARSE_FAILURE"
NULL_PRIMARY_KEY = "NULL_PRIMARY_KEY"

# Operator names accepted by filter rules (case-insensitive).
RULE_OPERATORS = ("equals", "not_equals", "in", "not_in", "is_not_null", "is_null")


@dataclass(frozen=True)
class FieldMapping:
    """One flat output column taken from a dotted path of the JSON document."""

    name: str
    path: str
    type: str = "string"

    def parts(self) -> list[str]:
        return self.path.split(".")


@dataclass(frozen=True)
class FilterRule:
    """Keep rows where ``field <operator> value(s)`` holds."""

    field: str
    operator: str
    value: Any = None
    values: Sequence[Any] | None = None

    @staticmethod
    def from_dict(d: Mapping[str, Any]) -> "FilterRule":
        values = d.get("values")
        return FilterRule(
            field=d["field"],
            operator=d["operator"],
            value=d.get("value"),
            values=None if values is None else tuple(values),
        )


@dataclass(frozen=True)
class Target:
    """Where good rows go: a Parquet directory or a catalog table."""

    path: str | None = None
    table: str | None = None

    def __post_init__(self):
        if (self.path is None) == (self.table is None):
            raise SpecError("Target needs exactly one of path= or table=")

    @property
    def is_table(self) -> bool:
        return self.table is not None

    def describe(self) -> str:
        return self.table if self.is_table else str(self.path)


def mappings_from_groups(
    groups: Iterable[Mapping[str, str]],
    type_overrides: Mapping[str, str] | Iterable[Mapping[str, str]] | None = None,
) -> list[FieldMapping]:
    """Expand grouped column lists into field mappings.

    Each group is ``{"path": "customer", "columns": "customer_id, first_name:fname"}``:
    the path is a prefix (empty = top level), ``src:target`` renames, blank
    entries are ignored.  Types default to string and are overridden by
    *target* name.
    """
    if type_overrides is None:
        overrides: dict[str, str] = {}
    elif isinstance(type_overrides, Mapping):
        overrides = dict(type_overrides)
    else:
        overrides = {o["name"]: o["type"] for o in type_overrides}
    out: list[FieldMapping] = []
    for g in groups:
        prefix = (g.get("path") or "").strip()
        cols = g.get("columns", "")
        if not isinstance(cols, str):
            cols = ",".join(cols)
        for entry in cols.split(","):
            entry = entry.strip()
            if not entry:
                continue
            src, _, tgt = entry.partition(":")
            src, tgt = src.strip(), (tgt.strip() or src.strip())
            path = src if not prefix else f"{prefix}.{src}"
            out.append(FieldMapping(tgt, path, overrides.get(tgt, "string")))
    return out


def mappings_from_fields(fields: Iterable[Mapping[str, str]]) -> list[FieldMapping]:
    """Explicit ``[{"name":…, "path":…, "type":…}]`` list (the documented shape)."""
    return [FieldMapping(f["name"], f.get("path", f["name"]), f.get("type", "string")) for f in fields]


def check_mappings(mappings: Sequence[FieldMapping], partition_column: str | None = None) -> None:
    """Reject mappings that would give an ambiguous or broken schema."""
    if not mappings:
        raise SpecError("at least one field mapping is required")
    seen: dict[str, str] = {}
    for m in mappings:
        if not m.name or not m.path or any(p == "" for p in m.parts()):
            raise SpecError(f"bad mapping {m!r}: empty name or path segment")
        if m.name in seen:
            raise SpecError(f"target column {m.name!r} is mapped twice ({seen[m.name]!r}, {m.path!r})")
        seen[m.name] = m.path
        if partition_column is not None and m.name == partition_column:
            raise SpecError(f"target column {m.name!r} collides with the partition column")
    paths = {m.path for m in mappings}
    for m in mappings:
        parts = m.parts()
        for i in range(1, len(parts)):
            prefix = ".".join(parts[:i])
            if prefix in paths:
                raise SpecError(f"path {prefix!r} is mapped as a leaf and also has child {m.path!r}")


@dataclass(frozen=True)
class PipelineSpec:
    """Everything one ingestion pipeline needs, fixed before the first batch."""

    mappings: tuple[FieldMapping, ...]
    primary_keys: tuple[str, ...]
    target: Target
    topic: str = ""
    partition_column: str = "audit_load_date"
    date_format: str = "yyyy-MM-dd"
    lookback_days: int | None = 2
    rules: tuple[FilterRule, ...] = ()
    error_path: str | None = None
    capture_errors: bool = True
    idempotent_errors: bool = True
    dedup_within_batch: bool = True
    dedup_order: tuple[str, ...] = ("_src.kafka_partition", "_src.kafka_offset")
    dedup_mode: str = "always"  # "always" | "reprocess"
    restrict_existing: bool = True  # semi-join the lookback keys on the measured batch keys first
    reserialize_null_key_rows: bool = False
    strict_json: bool = True
    on_type_mismatch: str = "keep"  # "keep" (leaf NULL, row good) | "error" (JSON_PARSE_FAILURE)
    on_unknown_type: str = "error"  # "error" | "string"
    transformer: Callable[..., DataFrame] | None = None
    flattener: Callable[..., DataFrame] | None = None
    flattener_schema: Any = None
    params: Mapping[str, str] = field(default_factory=dict)
    files_per_write: int | None = None  # None = let AQE size files after a rebalance
    max_records_per_file: int | None = None
    audit_path: str | None = None
    audit_table: str | None = None  # a catalog table instead of a path
    key_index: str | None = None  # a bucketed table of the stored keys, which the anti join reads instead of the target
    ledger_path: str | None = None  # steps of every batch, so that one that runs again is recognised
    atomic: bool = False  # rows, error rows and audit rows of a batch are seen together, when its last ledger row is written
    app_name: str = "streamload"
    as_of: _dt.datetime | _dt.date | None = None  # fixed clock; None = now per batch

    def __post_init__(self):
        object.__setattr__(self, "mappings", tuple(self.mappings))
        object.__setattr__(self, "primary_keys", tuple(self.primary_keys))
        object.__setattr__(self, "rules", tuple(self.rules))
        object.__setattr__(self, "dedup_order", tuple(self.dedup_order))
        object.__setattr__(self, "params", dict(self.params))
        if self.flattener is None:
            check_mappings(self.mappings, self.partition_column)
        if not self.primary_keys:
            raise SpecError("at least one primary key is required")
        if any("." in k for k in self.primary_keys):
            raise SpecError(f"a primary key with a dot cannot be told from a nested path: {self.primary_keys}")
        names = {m.name for m in self.mappings}
        if self.flattener is None and self.transformer is None:
            missing = [k for k in self.primary_keys if k not in names]
            if missing:
                raise SpecError(f"primary key(s) {missing} are not mapped columns")
        if self.lookback_days is not None and self.lookback_days < 0:
            raise SpecError("lookback_days must be >= 0 or None")
        if self.on_type_mismatch not in ("keep", "error"):
            raise SpecError("on_type_mismatch must be 'keep' or 'error'")
        if self.audit_path and self.audit_table:
            raise SpecError("audit rows go to audit_path or to audit_table, not to both")
        if self.atomic and not self.ledger_path:
            raise SpecError("atomic batches are published by a ledger: set ledger_path")
        if self.atomic and self.key_index:
            raise SpecError("a key index would hold keys of attempts that were never committed")
        if self.atomic and self.target.is_table:
            raise SpecError("atomic batches need a target path; a table's columns are its owner's")
        if self.dedup_mode not in ("always", "reprocess"):
            raise SpecError("dedup_mode must be 'always' or 'reprocess'")
        for r in self.rules:
            if r.operator.lower() not in RULE_OPERATORS:
                raise SpecError(f"rule on {r.field!r}: {r.operator!r} is none of {', '.join(RULE_OPERATORS)}")

    @property
    def mapped_columns(self) -> list[str]:
        return [m.name for m in self.mappings]

    def param(self, key: str, default: str = "") -> str:
        return self.params.get(key, default)

    def with_(self, **changes) -> "PipelineSpec":
        return replace(self, **changes)

    @staticmethod
    def from_dict(d: Mapping[str, Any], **extra) -> "PipelineSpec":
        """Build from a plain dict (e.g. loaded from JSON).

        Accepts ``json.groups`` (+ ``json.type_overrides``) or ``json.fields``;
        both shapes lower to the same list of :class:`FieldMapping`.
        """
        j = d.get("json", {})
        mappings: list[FieldMapping] = []
        if "fields" in j:
            mappings += mappings_from_fields(j["fields"])
        if "groups" in j:
            mappings += mappings_from_groups(j["groups"], j.get("type_overrides", j.get("type-overrides")))
        if "path" in d.get("target", {}) or "table" in d.get("target", {}):
            target = Target(path=d["target"].get("path"), table=d["target"].get("table"))
        else:
            target = Target(path=d.get("output_path"), table=d.get("table"))
        shaped = {"json", "target", "output_path", "table", "rules", "as_of"}
        plain = {f.name for f in fields(PipelineSpec)} - {"mappings"} - shaped
        unknown = sorted(set(d) - plain - shaped)
        if unknown:
            raise SpecError(f"unknown setting(s) {', '.join(unknown)}; known are {', '.join(sorted(plain | shaped))}")
        kwargs = {"mappings": mappings, "target": target, "rules": [FilterRule.from_dict(r) for r in d.get("rules", [])]}
        kwargs |= {k: v for k, v in d.items() if k in plain}
        if d.get("as_of"):  # ISO text; a fixed clock for backfills and tests
            as_of = d["as_of"]
            kwargs["as_of"] = _dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
        kwargs.update(extra)
        return PipelineSpec(**kwargs)
