"""The corpus pipeline: quality, repeated lines, near-duplicates, benchmark passages, packing.

Each stage's rows are written as Parquet to the session's shared folder and read again, so that a stage
starts from files and a lost executor never costs more than the stage that runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streamload.llm.common import materialize, table
from streamload.llm.decontamination import decontamination_stage
from streamload.llm.line_dedup import line_stage
from streamload.llm.packing import packing_stage
from streamload.llm.quality_classifier import quality_stage
from streamload.llm.simhash import simhash_stage

STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: A fitted model, fingerprints and token ids are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that every stage kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
