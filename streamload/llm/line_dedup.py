"""Line de-duplication by overlapping three-line windows (operator 10).

Lines are hashed in windows of three consecutive lines.  For each window that occurs more than once,
the first occurrence by (doc_id, line number) stays and the lines of all later ones are removed; lines
covered by several such windows merge into one run.  Windows are judged on the input.

The first occurrence is a ``min`` per hash, so a window that fills a third of the corpus is reduced to
one row per map task before the shuffle; the occurrences then meet it in an equi join whose hot
partitions Spark may split.  A window is identified by 96 bits (XXH64 and Murmur3 over the three lines).

Defined results: null and empty text have no lines; texts of fewer than three lines, and windows without
any visible character, are left alone; rows without doc_id come after all others; rows of equal doc_id and
equal text are one document that was read twice, and get the same result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import merged, table, whole_text

WINDOW = 3


def later_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document that loses lines: doc_id, key (hash of its text), starts of its later windows."""
    text = whole_text(docs)
    lines = F.split(text, "\n", -1)
    base = docs.select("doc_id", F.xxhash64(text).alias("key"), lines.alias("lines")).where(F.size("lines") >= window)
    at = base.select("doc_id", "key", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size("lines") - (window - 1)),
        lambda i: F.when(F.exists(F.slice("lines", i, window), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
                         F.struct(F.xxhash64(F.slice("lines", i, window)).alias("h"),
                                  F.hash(F.slice("lines", i, window)).alias("g"))))).alias("pos", "w"))
    at = at.where(F.col("w").isNotNull()).select("w.h", "w.g", F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "pos").alias("place"))
    first = at.groupBy("h", "g").agg(F.min("place").alias("first"), F.max("place").alias("last")) \
        .where(F.col("first") != F.col("last")).select("h", "g", "first")
    return at.join(first, ["h", "g"]).where(F.col("place") != F.col("first")) \
        .groupBy("place.doc_id", "place.key").agg(F.collect_set("place.pos").alias("starts"))


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()),
                            T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType())]))
def _without(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
    out = []
    for text, found in zip(texts, starts):
        lines = text.split("\n") if text else []
        if found is None:
            out.append((text, len(lines), 0, 0))
            continue
        runs = merged(np.sort(np.asarray(found, dtype=np.int64)), WINDOW, len(lines))
        kept, end = [], 0
        for a, b in runs:
            kept += lines[end:a]
            end = b
        kept += lines[end:]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept), len(runs)))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_removed", "n_spans"])


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with an added struct ``__llm_lines``: the remaining text, n_lines, n_removed, n_spans."""
    found = later_windows(docs).select(F.col("doc_id").alias("__llm_id"), F.col("key").alias("__llm_key"),
                                       F.col("starts").alias("__llm_starts"))
    keyed = docs.withColumn("__llm_hash", F.xxhash64(whole_text(docs)))
    joined = keyed.join(found.hint("shuffle_hash"), keyed["doc_id"].eqNullSafe(F.col("__llm_id"))
                        & (F.col("__llm_hash") == F.col("__llm_key")), "left")
    return joined.withColumn("__llm_lines", _without(F.coalesce("text", F.lit("")), "__llm_starts")) \
        .drop("__llm_hash", "__llm_id", "__llm_key", "__llm_starts")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "__llm_lines.n_lines", "__llm_lines.n_removed", "__llm_lines.n_spans",
                                    F.sha2("__llm_lines.text", 256).alias("kept_sha256"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without their repeated lines; ``n_chars`` follows the text.

    Every row stays, also one whose text is all removed (it is empty then); null stays null.  Rows of equal doc_id and text,
    and copies without an id, are one document read several times: none of them removes the other's lines.
    """
    out = dedup_lines(docs)
    new = {"text": F.when(F.col("text").isNotNull(), F.col("__llm_lines.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(new["text"]).cast(docs.schema["n_chars"].dataType)
    return out.withColumns(new).select(*docs.columns)


OP10_SQL = r"""
WITH d AS (SELECT doc_id, text, CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
w AS (SELECT doc_id, pos, a, b, c FROM (
        SELECT doc_id, pos, line AS a, lead(line, 1) OVER s AS b, lead(line, 2) OVER s AS c FROM l
        WINDOW s AS (PARTITION BY doc_id ORDER BY pos))
      WHERE c IS NOT NULL AND regexp_matches(a || b || c, '[^\x20\x09-\x0D]')),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS k FROM w),
gone AS (SELECT DISTINCT doc_id, pos + o AS pos FROM r, (SELECT unnest([0, 1, 2]) AS o) WHERE k > 1),
m AS (SELECT l.doc_id, l.pos, l.line, gone.pos IS NOT NULL AS out,
             coalesce(lag(gone.pos IS NOT NULL) OVER (PARTITION BY l.doc_id ORDER BY l.pos), FALSE) AS before
      FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos),
s AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE out) AS n_removed,
             count(*) FILTER (WHERE out AND NOT before) AS n_spans,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT out), '') AS kept
      FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s ON d.doc_id = s.doc_id
"""
