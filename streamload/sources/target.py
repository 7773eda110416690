"""Scan of the existing target (SRC-4 … SRC-6)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..spec import SpecError, Target

# Error conditions that mean "nothing has been written yet".
MISSING_PATH_CONDITIONS = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _condition(e: AnalysisException) -> str | None:
    for getter in ("getCondition", "getErrorClass"):
        fn = getattr(e, getter, None)
        if fn is not None:
            try:
                return fn()
            except Exception:  # noqa: BLE001
                continue
    return None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can find the path (a glob too)."""
    try:
        spark.read.text(path)
        return True
    except AnalysisException as e:
        if _condition(e) in MISSING_PATH_CONDITIONS:
            return False
        raise


def read_target(spark: SparkSession, target: Target | str, *, schema: T.StructType | None = None
                ) -> DataFrame | None:
    """The target as a DataFrame, or ``None`` when it does not exist yet.

    Only a missing path / empty directory / missing table means "first run";
    every other analysis error (wrong column, wrong type …) is raised, so a
    schema mistake cannot silently switch dedup off.  ``schema`` (for path
    targets) fixes column types, e.g. the load-date column as STRING instead
    of whatever partition discovery infers, and prunes columns at the scan.
    """
    if isinstance(target, str):
        target = Target(path=target)
    if target.is_table:
        if not spark.catalog.tableExists(target.table):
            return None
        return spark.table(target.table)
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(target.path)
    except AnalysisException as e:
        if _condition(e) in MISSING_PATH_CONDITIONS:
            return None
        raise


#: Columns of stored datasets that have been found and checked once: a micro-batch need not list and open files for them
#: again.  A later file that lacks a key gives NULL, which the anti join's check of the keys raises on; one that stores it
#: as another type fails in the scan.
_CHECKED: dict[tuple, list[T.StructField]] = {}
MAX_CHECKED = 1_000


def read_stored(spark: SparkSession, path: str, columns, partition_column: str, values=None, *,
                optional: T.StructType | None = None) -> DataFrame | None:
    """``columns`` of a Parquet target as they are stored, plus the load date as STRING; ``None`` before the first write.

    ``values`` limits the read to those load dates.  ``optional`` columns are NULL in files that lack them.  A column that the stored files do not have raises: reading it with
    an imposed schema would give NULL for every row, and an anti join would then match nothing.
    """
    def read(schema):
        return read_target(spark, path, schema=schema) if values is None else \
            read_partitions(spark, path, partition_column, values, schema=schema)
    key = (spark.sparkContext.applicationId, path, tuple(columns))
    if key not in _CHECKED:
        seen = read(None)
        if seen is None:
            return None
        stored = {f.name: f for f in seen.schema.fields}
        missing = [c for c in columns if c not in stored]
        if missing:
            raise SpecError(f"{path} has no column(s) {', '.join(missing)}; it has {', '.join(stored)}")
        if len(_CHECKED) >= MAX_CHECKED:
            _CHECKED.clear()
        _CHECKED[key] = [stored[c] for c in columns]
    more = list(optional.fields) if optional is not None else []
    return read(T.StructType(_CHECKED[key] + more + [T.StructField(partition_column, T.StringType(), True)]))


def read_rows(spark: SparkSession, target: Target | str, partition_column: str = "audit_load_date"
              ) -> DataFrame | None:
    """All rows of a target with the load-date column as written (STRING).

    Partition discovery would turn ``yyyy-MM-dd`` values into DATE and
    ``yyyyMMdd`` into INT; reading with the stored file schema plus a STRING
    partition column keeps the value exactly as it was formatted.
    """
    if isinstance(target, str):
        target = Target(path=target)
    df = read_target(spark, target)
    if df is None or target.is_table:
        return df
    fields = [f for f in df.schema.fields if f.name != partition_column]
    schema = T.StructType(fields + [T.StructField(partition_column, T.StringType(), True)])
    return spark.read.schema(schema).parquet(target.path)


# Characters Spark escapes (as %XX) in partition directory names.
_ESCAPED = set('"#%\'*/:=?\\\x7f{[]^') | {chr(i) for i in range(1, 32)}
_GLOB_SPECIAL = set("{}[]*?\\,")


def escape_partition_value(value: str) -> str:
    """A partition value as Spark writes it into a ``col=value`` directory name."""
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)


def read_partitions(spark: SparkSession, path: str, partition_column: str, values, *,
                    schema: T.StructType | None = None) -> DataFrame | None:
    """Rows of the given partition values of a Parquet directory, listing only those folders.

    A dedup lookback needs 3 of possibly thousands of daily partitions;
    reading ``path`` itself would list every file of the target on every
    batch.  Here a brace glob ``col={v1,v2,…}`` under ``basePath`` makes
    Spark list only the matching folders.  ``None`` when none of them
    exists (nothing to compare against).  The partition column is read as
    STRING when ``schema`` says so.
    """
    values = list(values)
    names = [escape_partition_value(v) for v in values]
    if not names or any(ch in _GLOB_SPECIAL for n in names for ch in n):
        df = read_target(spark, Target(path=path), schema=schema)
        return None if df is None else df.filter(df[partition_column].cast("string").isin(values))
    base = path.rstrip("/")
    glob = f"{base}/{partition_column}={{{','.join(names)}}}"
    reader = spark.read.option("basePath", base)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.parquet(glob)
    except AnalysisException as e:
        if _condition(e) in MISSING_PATH_CONDITIONS:
            return None
        raise
