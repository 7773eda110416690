"""Column expressions shared by the operators: clock, load date, keys."""

from __future__ import annotations

import datetime as _dt
import functools
from collections.abc import Sequence
from functools import reduce
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote_path(path: str) -> str:
    """Back-quote every segment of a dotted path so odd names resolve."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in path.split("."))


def ident(name: str) -> str:
    """One back-quoted identifier (a flat column name may itself contain dots)."""
    return "`" + name.replace("`", "``") + "`"


def path_col(path: str, root: str | None = None) -> Column:
    return F.col(quote_path(path if root is None else f"{root}.{path}"))


def variant_path(path: str) -> str:
    """A dotted mapping path as a VARIANT path: ``a.b`` -> ``$.a.b``, odd names bracketed."""
    import re
    out = "$"
    for seg in path.split("."):
        if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", seg):
            out += "." + seg
        elif "'" in seg:
            raise ValueError(f"path segment {seg!r} cannot be addressed in a VARIANT path")
        else:
            out += f"['{seg}']"
    return out


def resolve_as_of(as_of: _dt.datetime | _dt.date | str | None) -> _dt.datetime:
    """Fix the batch clock once on the driver: wall-clock time of the session's time zone.

    ``None`` is now; a value with a zone is converted to the session's; one without is taken as it is.
    """
    if as_of is None:
        as_of = _dt.datetime.now(_dt.timezone.utc)
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    if isinstance(as_of, _dt.datetime):
        return as_of if as_of.tzinfo is None else as_of.astimezone(_session_zone()).replace(tzinfo=None)
    return _dt.datetime(as_of.year, as_of.month, as_of.day)


def _session_zone() -> _dt.tzinfo:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return _dt.timezone.utc if spark is None else _zone(spark.conf.get("spark.sql.session.timeZone"))


def _zone(name: str) -> _dt.tzinfo:
    """A session time zone: a region, ``UTC`` / ``Z``, or an offset such as ``+02:00``."""
    try:
        return ZoneInfo(name)
    except (ZoneInfoNotFoundError, ValueError):
        text = name.removeprefix("UTC").removeprefix("GMT") or "+00:00"
        return _dt.datetime.strptime(text, "%z").tzinfo or _dt.timezone.utc


def as_of_lit(as_of: _dt.datetime) -> Column:
    """The batch clock as a wall-clock timestamp literal: text, so no zone shifts it."""
    return F.expr(f"TIMESTAMP_NTZ '{as_of.isoformat(sep=' ')}'")


def load_date(as_of: _dt.datetime, fmt: str) -> Column:
    """Load-date partition value: ``date_format(as_of, fmt)`` as STRING (PRJ-10).

    A literal, so every action of a batch sees the same date even across
    midnight, and Catalyst folds it to a constant.
    """
    return F.date_format(as_of_lit(as_of), fmt)


def lookback_dates(as_of: _dt.datetime, days: int, fmt: str) -> list[Column]:
    """The ``days + 1`` formatted load dates as_of-days … as_of (FLT-10)."""
    return [F.date_format(as_of_lit(as_of - _dt.timedelta(days=i)), fmt) for i in range(days + 1)]


def any_null(cols: Sequence[str]) -> Column:
    """OR over ``col IS NULL`` for every key (FLT-9)."""
    return F.expr(" OR ".join(f"{quote_path(c)} IS NULL" for c in cols))


@functools.lru_cache(maxsize=256)
def lookback_values(as_of: _dt.datetime, days: int, fmt: str) -> tuple[str, ...]:
    """The lookback load dates as driver-side strings, newest first.

    Spark formats them, by the same expression as the stored column, over one constant row (folded, so no job runs).
    """
    return tuple(str(v) for v in constants(*lookback_dates(as_of, days, fmt)))


def constants(*cols: Column) -> tuple:
    """Values of constant expressions, evaluated by the optimizer."""
    from pyspark.sql import SparkSession
    return tuple(SparkSession.getActiveSession().sql("SELECT 1 AS one").select(*cols).first())
