"""The commit ledger: how far each batch of each run has come (AUD-4, STR-7, SNK-1, SNK-3, AUD-1).

A batch is known by its run and its batch id, which a query keeps across restarts (the run is the query's id in the
checkpoint).  Each step of a batch appends one row, after what it did::

    begun ─► data ─► errors ─► audited

So a batch that runs again is recognised by its rows, without comparing keys:

* no row, or it began and nothing more is known: everything is to do.  Its rows may have been appended just before the
  stop, so this is the one case in which the batch is compared with the target whatever the dedup mode;
* ``data`` or ``errors``: those appends are not repeated;
* ``audited``: nothing is to do.

With ``atomic`` batches (``PipelineSpec.atomic``) the ledger is also what publishes a batch.  Every attempt at a batch writes
its rows, error rows and audit rows with the attempt's name in a column, and one ledger row, ``audited``, makes all of them
visible: :func:`committed_rows` shows the rows of committed attempts, and rows from before there was a ledger.  A stopped
attempt is never seen and never repaired; the batch runs again as another attempt.

The ledger is a small append-only Parquet dataset, in a folder per app and run, so a start reads its own run's rows only.
A write is one file that Spark's commit protocol shows whole or not at all.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import PipelineSpec, SpecError
from ..sources.target import escape_partition_value, read_target

BEGUN, DATA, ERRORS, AUDITED = STEPS = ("begun", "data", "errors", "audited")
#: The column that names the attempt in the rows of atomic batches.
ATTEMPT = "load_attempt"

LEDGER_SCHEMA = T.StructType([
    T.StructField("app", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("attempt", T.StringType()),
    T.StructField("step", T.IntegerType()),
    T.StructField("n_written", T.LongType()),
    T.StructField("n_bad_written", T.LongType()),
    T.StructField("recorded_at", T.TimestampType()),
])
# Folder levels of the ledger.
LEDGER_PARTITIONS = ("app", "run_id")


class Entry(NamedTuple):
    """The furthest step of a batch, and what it had written by then."""

    step: str
    attempt: str
    n_written: int
    n_bad_written: int


def append_entry(spark: SparkSession, path: str, app: str, run_id: str, batch_id: int, attempt: str, step: str,
                 n_written: int = 0, n_bad_written: int = 0) -> None:
    row = spark.range(1).select(
        F.lit(app).alias("app"), F.lit(run_id).alias("run_id"), F.lit(int(batch_id)).cast("long").alias("batch_id"),
        F.lit(attempt).alias("attempt"), F.lit(STEPS.index(step)).alias("step"), F.lit(int(n_written)).cast("long").alias("n_written"),
        F.lit(int(n_bad_written)).cast("long").alias("n_bad_written"), F.current_timestamp().alias("recorded_at"))
    row.coalesce(1).write.mode("append").partitionBy(*LEDGER_PARTITIONS).parquet(path)


def read_ledger(spark: SparkSession, path: str, app: str | None = None, run_id: str | None = None) -> DataFrame | None:
    """The ledger's rows, or those of one run (only its folder is listed); None before the first."""
    if app is None or run_id is None:
        return read_target(spark, path, schema=LEDGER_SCHEMA)
    folder = f"{path.rstrip('/')}/app={escape_partition_value(app)}/run_id={escape_partition_value(run_id)}"
    schema = T.StructType([f for f in LEDGER_SCHEMA.fields if f.name not in LEDGER_PARTITIONS])
    rows = read_target(spark, folder, schema=schema)
    return None if rows is None else rows.withColumns({"app": F.lit(app), "run_id": F.lit(run_id)})


def latest_entries(ledger: DataFrame) -> DataFrame:
    """One row per batch: app, run_id, batch_id, its furthest step (name) with that attempt and its counts."""
    by_step = F.struct("step", "recorded_at", "attempt", "n_written", "n_bad_written")
    last = ledger.groupBy("app", "run_id", "batch_id").agg(F.max(by_step).alias("last"))
    names = F.array(*[F.lit(s) for s in STEPS])
    return last.select("app", "run_id", "batch_id", F.element_at(names, F.col("last.step") + 1).alias("step"),
                       "last.attempt", "last.n_written", "last.n_bad_written")


def find_entry(spark: SparkSession, path: str, app: str, run_id: str, batch_id: int) -> Entry | None:
    ledger = read_ledger(spark, path, app, run_id)
    if ledger is None:
        return None
    rows = latest_entries(ledger.filter(F.col("batch_id") == int(batch_id))).collect()  # one row at most
    return Entry(rows[0]["step"], rows[0]["attempt"], rows[0]["n_written"], rows[0]["n_bad_written"]) if rows else None


def committed_attempts(spark: SparkSession, path: str) -> DataFrame | None:
    """The attempts that were published: for each batch the first that was, should two drivers ever run it at once."""
    ledger = read_ledger(spark, path)
    if ledger is None:
        return None
    done = ledger.filter(F.col("step") == STEPS.index(AUDITED))
    return done.groupBy("app", "run_id", "batch_id").agg(F.min_by("attempt", F.struct("recorded_at", "attempt")).alias(ATTEMPT))


def committed_rows(rows: DataFrame | None, attempts: DataFrame | None) -> DataFrame | None:
    """``rows`` of committed attempts and rows without an attempt (from before the ledger), without that column.

    ``attempts`` must have been read before ``rows``: then whatever it names had been written whole by the time ``rows``
    was listed, and a batch that is being written meanwhile is not seen.
    """
    if rows is None or ATTEMPT not in rows.columns:
        return rows
    plain = rows.filter(F.col(ATTEMPT).isNull())
    if attempts is not None:
        plain = plain.unionByName(rows.join(attempts.select(ATTEMPT), ATTEMPT, "left_semi"))
    return plain.drop(ATTEMPT)


class BatchLog:
    """One batch's place in the ledger; without a ledger, it knows nothing and records nothing."""

    def __init__(self, spark: SparkSession, spec: PipelineSpec, run_id: str, batch_id: int, *, resume: bool = True,
                 on_step: Callable[[str], None] | None = None):
        if spec.ledger_path and not run_id:
            raise SpecError("a ledger needs a run_id: batch ids alone start again at 0 with each run")
        self.spark, self.spec, self.run_id, self.batch_id, self.on_step = spark, spec, run_id, batch_id, on_step
        self.found = find_entry(spark, spec.ledger_path, spec.app_name, run_id, batch_id) if spec.ledger_path and resume else None
        self.attempt = f"a{uuid.uuid4().hex}"

    @property
    def repeated(self) -> bool:
        """Whether the batch had begun before."""
        return self.found is not None

    def has(self, step: str) -> bool:
        """Whether an earlier attempt got past ``step``.  Of an atomic batch only the whole counts."""
        if self.found is None or (self.spec.atomic and self.found.step != AUDITED):
            return False
        return STEPS.index(self.found.step) >= STEPS.index(step)

    def record(self, step: str, n_written: int = 0, n_bad_written: int = 0) -> None:
        """Tell the observer, then note the step; an atomic batch needs no row between its first and its last."""
        if self.on_step is not None:
            self.on_step(step)
        if self.spec.ledger_path and not (self.spec.atomic and step in (DATA, ERRORS)):
            append_entry(self.spark, self.spec.ledger_path, self.spec.app_name, self.run_id, self.batch_id, self.attempt, step,
                         n_written, n_bad_written)
