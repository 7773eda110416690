"""Benchmark decontamination by pigeonhole edit matching (operator 7).

Texts and test items are lower-cased and their white space is collapsed.  An item of m characters may
differ from a passage by ``k = floor(m * error_rate)`` edits.  Cut into k + 1 pieces, at least one piece
survives k edits unchanged, so every passage within the budget is found by an exact hit of a piece
(one Aho-Corasick pass over the text); Myers' bit-parallel distance then verifies the surroundings of the hit.

The documents are only scanned: the items are broadcast in blocks whose size is measured first
(``block_chars``), one scan for each block, and no row is shuffled.

Defined results: null and empty texts match nothing; items that are null or shorter than ``min_chars``
after normalisation are not searched (they would match ordinary prose); rows without doc_id give rows
without doc_id; repeated documents and items each give their own rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, table, whole_text

ERROR_RATE, MIN_CHARS, BLOCK_CHARS = 0.08, 24, 2_000_000


def normalise(text: str) -> str:
    return " ".join(text.lower().split())


def myers(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(least edit distance of the pattern to a substring of ``text``, where the first such substring ends)."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = (mv | ~(xh | pv)) & full, pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
            if score < best:
                best, end = score, j + 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv, mv = (mh | ~(xv | ph)) & full, ph & xv
    return best, end


def _masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for k, c in enumerate(pattern):
        out[c] = out.get(c, 0) | (1 << k)
    return out


class Matcher:
    """The items of one block: pieces in an automaton, bit masks for the verification."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.items = [(name, text, int(len(text) * error_rate)) for name, text in items]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for at, (_, text, k) in enumerate(self.items):
            cuts = [len(text) * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(text[a:b], []).append((at, a))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()
        self.masks: dict[int, tuple[dict[str, int], dict[str, int]]] = {}

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, distance, start, end) in the normalised text: the best passage of each item found."""
        best: dict[int, tuple[int, int, int]] = {}
        tried: set[tuple[int, int]] = set()
        for last, (size, places) in self.automaton.iter(text) if len(self.automaton) else ():
            for at, offset in places:
                start = last + 1 - size - offset
                if (at, start) in tried or (at in best and best[at][0] == 0):
                    continue
                tried.add((at, start))
                if (got := self._verify(at, start, text)) and (at not in best or got < best[at]):
                    best[at] = got
        for at, (distance, a, b) in sorted(best.items()):
            yield self.items[at][0], distance, a, b

    def _verify(self, at: int, start: int, text: str) -> tuple[int, int, int] | None:
        _, item, k = self.items[at]
        if text.startswith(item, max(start, 0)) and start >= 0:
            return 0, start, start + len(item)
        if not k:
            return None
        low, high = max(start - k, 0), start + len(item) + k
        forward, backward = self.masks.get(at) or self.masks.setdefault(at, (_masks(item), _masks(item[::-1])))
        distance, end = myers(forward, len(item), text[low:high])
        if distance > k:
            return None
        end += low
        _, back = myers(backward, len(item), text[max(end - len(item) - k, 0):end][::-1])
        return distance, end - back, end


def _blocks(benchmark: DataFrame, min_chars: int, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The usable items in blocks of at most ``block_chars`` characters (or of one item that is longer)."""
    text = F.trim(F.regexp_replace(F.lower(benchmark["text"]), r"\s+", " "))
    items = benchmark.select("item_id", text.alias("text")).where(F.length("text") >= min_chars)
    size = F.length("text")
    total, rows = items.agg(F.coalesce(F.sum(size), F.lit(0)), F.count("*")).first()
    n = total // block_chars + 1 if total else 0
    while True:
        block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n or 1))
        most = items.groupBy(block.alias("b")).agg(F.sum(size).alias("chars"), F.countDistinct("text").alias("texts"))
        if not n or n > 2 * rows or most.where((F.col("chars") > 2 * block_chars) & (F.col("texts") > 1)).isEmpty():
            break
        n *= 2
    for k in range(n):
        found = items.where(block == k).orderBy("item_id", "text").collect()
        usable = [(r.item_id, t) for r in found if len(t := normalise(r.text)) >= min_chars]
        if usable:
            yield usable


def unsearched(benchmark: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The items that are not searched: null, or shorter than ``min_chars`` after normalisation."""
    text = F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"\s+", " "))
    return benchmark.where(F.length(text) < min_chars)


class _SharedMatcher:
    """The matcher of one block: made from the broadcast items when a task first asks for it, then kept for the task."""

    def __init__(self, spark: SparkSession, items: list[tuple[int, str]], error_rate: float):
        self.items, self.error_rate, self.made = spark.sparkContext.broadcast(items), error_rate, None

    def __getstate__(self):
        return {"items": self.items, "error_rate": self.error_rate, "made": None}

    def __call__(self) -> Matcher:
        if self.made is None:
            self.made = Matcher(self.items.value, self.error_rate)
        return self.made


def find_passages(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS,
                  block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and item found: doc_id, item_id, distance, start, end.

    Positions are code points of the normalised text; the passage is the best one of the item in the document.
    """
    spark = docs.sparkSession
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("item_id", benchmark.schema["item_id"].dataType)]
                          + [T.StructField(c, T.IntegerType()) for c in ("distance", "start", "end")])
    base = docs.select("doc_id", whole_text(docs).alias("text"))
    out = spark.createDataFrame([], schema)
    for items in _blocks(benchmark, min_chars, block_chars):
        def run(batch: pa.RecordBatch, shared=_SharedMatcher(spark, items, error_rate)) -> pa.RecordBatch:
            matcher = shared()
            ids, rows = batch.column(0), []
            for k, text in enumerate(batch.column(1).to_pylist()):
                rows += [(k, *m) for m in matcher.matches(normalise(text))]
            at, item, distance, start, end = zip(*rows) if rows else ((),) * 5
            return pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at, pa.int32())), pa.array(item, pa.int64()), *(pa.array(x, pa.int32())
                                                                                   for x in (distance, start, end))],
                schema.names)
        out = out.union(map_batches(base, run, schema))
    return out


def _holds(shared: _SharedMatcher):
    """An Arrow function: does a text hold a passage of the block's items?"""
    @F.pandas_udf(T.BooleanType())
    def holds(texts: pd.Series) -> pd.Series:
        matcher = shared()
        return texts.map(lambda t: next(matcher.matches(normalise(t)), None) is not None).astype(bool)
    return holds


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE,
                      min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the documents that hold a passage of an item."""
    for items in _blocks(benchmark, min_chars, block_chars):
        docs = docs.where(~_holds(_SharedMatcher(docs.sparkSession, items, error_rate))(whole_text(docs)))
    return docs


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_passages(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark passage go.

    Every row is judged by its text alone, so repeated rows and rows without an id share the fate of their text; null and
    empty texts hold nothing and stay.  Repeated or empty items change nothing.
    """
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))
