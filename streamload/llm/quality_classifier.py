"""Quality classifier: a sparse rule ensemble (operator 5).

Shallow boosted trees over text statistics are grown on a bounded sample of labelled documents.
Every path from a root becomes a conjunctive rule, an L1-penalised logistic regression keeps a few
of the rules, and those are compiled into one Spark column expression over the statistics.  Scoring
is therefore a scan, one Arrow function for the statistics, and code-generated comparisons.

Defined results: null and empty text have all statistics zero and are scored like any other row; null
or repeated ``doc_id`` rows are scored each on its own; labels that are null, or of documents that do
not exist, are ignored, and contradicting labels of one document count as the lower one; without
usable labels, or with one class only, every document gets the share of label 1 (0.5 if there is none).
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, whole_text

#: Statistics, in the order in which ``text_statistics`` gives them.
STATISTICS = ("log_words", "mean_word", "upper_share", "symbol_share", "bang_share", "pipe_share", "digit_share",
              "punct_share", "distinct_share", "top_word_share", "neighbour_share", "line_words", "repeat_line_share",
              "high_byte_share")
#: Bound on the labelled documents that the model is fitted on.
MAX_TRAIN = 20_000
THRESHOLD = 0.3

_UPPER, _LOWER, _DIGIT = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91], _LOWER[97:123], _DIGIT[48:58] = True, True, True
_SYMBOL, _PUNCT = np.zeros(256, bool), np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_PUNCT[list(b".,;:!?'\"()-")] = True


def _statistics_of(text: str) -> tuple[float, ...]:
    raw = text.encode("utf-8", "replace")
    n_bytes = max(len(raw), 1)
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    n = max(len(words), 1)
    seen = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = max(int(by_byte[_UPPER].sum() + by_byte[_LOWER].sum()), 1)
    same = sum(map(bytes.__eq__, words, words[1:]))
    return (float(np.log1p(len(words))), sum(map(len, words)) / n, by_byte[_UPPER].sum() / letters,
            by_byte[_SYMBOL].sum() / n_bytes, by_byte[33] / n, by_byte[124] / n, by_byte[_DIGIT].sum() / n_bytes,
            by_byte[_PUNCT].sum() / n, len(seen) / n, max(seen.values(), default=0) / n, same / n,
            n / max(len(lines), 1), 1 - len(set(lines)) / max(len(lines), 1), by_byte[128:].sum() / n_bytes)


@F.pandas_udf(T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS]))
def text_statistics(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_statistics_of(t) for t in texts], columns=list(STATISTICS), dtype=float)


# --------------------------------------------------------------------------- trees, rules, lasso

Rule = tuple[tuple[int, bool, float], ...]  # (statistic, goes up, cut): x > cut, or else x <= cut


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    def matrix(self, x: np.ndarray) -> np.ndarray:
        return _holds(self.rules, x)

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = self.matrix(x) @ np.array(self.weights) + self.intercept if self.rules else np.full(len(x), self.intercept)
        return 1 / (1 + np.exp(-z))

    def column(self, stats: Column) -> Column:
        """The score as a column expression over the statistics struct."""
        z = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            cond = F.lit(True)
            for at, up, cut in rule:
                x = stats.getField(STATISTICS[at])
                cond = cond & ((x > F.lit(cut)) if up else (x <= F.lit(cut)))
            z = z + F.when(cond, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _holds(rules: tuple[Rule, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)), bool)
    for j, rule in enumerate(rules):
        for at, up, cut in rule:
            out[:, j] &= (x[:, at] > cut) if up else (x[:, at] <= cut)
    return out.astype(float)


def _grow(x, bins, cuts, grad, hess, rows, depth, path, rules, step):
    """Split ``rows`` by the largest gain, note each path as a rule, add leaf steps to ``step``."""
    least = max(5, len(x) // 400)
    best = None
    g, h = grad[rows].sum(), hess[rows].sum()
    if depth:
        for at in range(x.shape[1]):
            if not len(cuts[at]):
                continue
            size = len(cuts[at]) + 1
            b = bins[rows, at]
            n = np.bincount(b, minlength=size).cumsum()[:-1]
            gl = np.bincount(b, grad[rows], size).cumsum()[:-1]
            hl = np.bincount(b, hess[rows], size).cumsum()[:-1]
            gain = gl ** 2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g ** 2 / (h + 1)
            gain[(n < least) | (len(rows) - n < least)] = 0
            k = int(gain.argmax())
            if gain[k] > (best[0] if best else 1e-6):
                best = (gain[k], at, k)
    if not best:
        step[rows] = g / (h + 1)
        return
    _, at, k = best
    low = bins[rows, at] <= k
    for up, part in ((False, rows[low]), (True, rows[~low])):
        more = (*path, (at, up, float(cuts[at][k])))
        rules.setdefault(tuple(sorted(more)), None)
        _grow(x, bins, cuts, grad, hess, part, depth - 1, more, rules, step)


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, penalty: float = 2e-3) -> RuleModel:
    """Boosted trees for the rules, then lasso logistic weights by accelerated proximal gradient steps."""
    share = float(y.mean()) if len(y) else 0.5
    start = float(np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3))))
    if len(y) < 20 or share in (0.0, 1.0):
        return RuleModel((), (), start)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, 49)))[:-1] if np.ptp(x[:, j]) else np.array([])
            for j in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    rules: dict[Rule, None] = {}
    z = np.full(len(y), start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        step = np.zeros(len(y))
        _grow(x, bins, cuts, y - p, p * (1 - p), np.arange(len(y)), depth, (), rules, step)
        z += 0.3 * step
    if not rules:
        return RuleModel((), (), start)
    names = tuple(rules)
    a = _holds(names, x)
    centre, scale = a.mean(0), np.maximum(a.std(0), 0.05)
    a = (a - centre) / scale
    rate = 4 * len(y) / max(np.linalg.norm(a, 2) ** 2, 1e-9)
    w, v, b, t = np.zeros(len(names)), np.zeros(len(names)), start, 1.0
    for _ in range(600):
        err = 1 / (1 + np.exp(-(a @ v + b))) - y
        b -= 2 * err.mean()
        u = v - rate * (a.T @ err) / len(y)
        new = np.sign(u) * np.maximum(np.abs(u) - rate * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    weights = w[kept] / scale[kept]
    return RuleModel(tuple(names[k] for k in kept), tuple(map(float, weights)), float(b - weights @ centre[kept]))


# --------------------------------------------------------------------------- Spark side

def labelled_sample(labels: DataFrame, label: str, folds: int, held: int, max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled ids outside the held-out fold: those of the smallest hash, so that the choice
    depends neither on order nor on partitioning."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    one = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(label).cast("double").alias("y"))
    return one.where(fold != held).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)


def one_per_id(rows: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of one row per doc_id, the least, however often the id is in the table: as many rows as ids."""
    return rows.groupBy("doc_id").agg(F.min(F.struct(*columns)).alias("one")).select("one.*")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held: int = 0,
          max_train: int = MAX_TRAIN) -> RuleModel:
    """Fit on at most ``max_train`` labelled rows.  Their ids (bounded) are broadcast and only their statistics,
    a few numbers a row, come to the driver."""
    ids = labelled_sample(labels, label, folds, held, max_train)
    rows = one_per_id(docs.select("doc_id", whole_text(docs).alias("text")).join(F.broadcast(ids), "doc_id")
                      .select("doc_id", "y", text_statistics("text").alias("s")), "y", "s").select("y", "s.*").toPandas()
    rows = rows.sort_values(list(rows.columns), ignore_index=True)
    return fit_rules(rows[list(STATISTICS)].to_numpy(float), rows["y"].to_numpy(float))


def score_documents(docs: DataFrame, model: RuleModel, column: str = "score") -> DataFrame:
    """``docs`` with the model's score in ``column`` (which replaces a column of that name)."""
    return docs.withColumn("__llm_stats", text_statistics(whole_text(docs))) \
        .withColumn(column, model.column(F.col("__llm_stats"))).drop("__llm_stats")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return score_documents(docs, model).select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go.

    Every row is judged by its text alone: repeated rows and rows without an id share the fate of their text.  Null and empty
    texts are one text, with statistics of zero.  Without usable labels the score is the same for all, so all or none go.
    """
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs, model, "__llm_score").where(F.col("__llm_score") >= THRESHOLD).select(*docs.columns)
