"""Toxicity by a weighted lexicon (operator 4).

Texts are folded: lower case, compatibility forms and accents removed, homoglyphs of other scripts and
digits or signs that stand for letters inside a word mapped to Latin letters (l, i and 1 become one letter).
A run of them at a word's end may be letters (``idio7``) or noise (``idiot$$``): the word is read without it in its place,
and with it after the end of the text.  (A run of exclamation marks alone is noise.)
The lexicon and its weights are log-odds of terms over a bounded sample of labelled documents (``MAX_TRAIN`` ids, those of
the smallest hash, one row each).  The lexicon is what has the most evidence, ``MAX_TERMS`` terms and ``MAX_EXCEPTIONS``
phrases at most; they are parameters of the fitted model, like its threshold of evidence, and drop no row.  Families of near
copies (by min-hash bands) count once, so that copies of one document cannot make a term.  Phrases in which a lexicon
word is harmless are exceptions.  One Aho-Corasick pass finds both; hits inside an exception phrase do not count.
The score is a logistic function of the weighted hits, plain and normalised by length.

Defined results: null and empty text have no hits and get the score of a text without hits; repeated rows
and rows without doc_id are scored each on its own; null labels and labels without a document are ignored, of
contradicting labels the lower one counts; without usable labels, or with one class only, the score
is the share of label 1 for every text (0 if there are no labels).
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, mix, pair, table, whole_text
from .quality_classifier import labelled_sample, one_per_id

MAX_TRAIN, MAX_TERMS, MAX_EXCEPTIONS = 20_000, 2_000, 2_000
THRESHOLD = 0.3
#: Letters of a stem: a term that ends in * stands for all longer words that begin with it.
STEM = 7
#: Least likelihood ratio statistic of a term: beyond what the best of some ten thousand chance terms reaches.
MIN_EVIDENCE = 24.0

# Letters of other scripts that look like Latin ones, and signs that stand for letters.
_LOOKALIKES = dict(zip("авекмнорстухіјѕԁɡһԛԝαβγεηικνορτυχωıłøđ", "abekmhopctyxijsdghqwabyenikvoptuxwilod"))
_SIGNS = dict(zip("0134578@$!", "oieastbasi"))

_DROP = dict.fromkeys([*range(0x300, 0x370), 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD])
_OTHER = {ord(k): v for k, v in _LOOKALIKES.items()} | _DROP
_INSIDE = re.compile(r"(?<![0-9@$!])[0134578@$!]+(?=[a-z])")
_SIGN_RUN = re.compile(r"[0134578@$!]+(?![^\W_]|[@$!])")
_SIGN_TABLE = {ord(k): v for k, v in _SIGNS.items()}
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """The folded words of a text, with one blank before, between and after them; last, the other reading of words that
    end in signs."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).translate(_OTHER)
    text = _INSIDE.sub(lambda m: m[0].translate(_SIGN_TABLE), text)
    return " " + " ".join(_WORD.findall(text) + _endings(text)).replace("l", "i") + " "


def _endings(text: str) -> list[str]:
    """The words that end in signs, with these read as letters."""
    out = []
    for m in _SIGN_RUN.finditer(text):
        start = at = m.start()
        if m[0].count("!") < len(m[0]):
            while start and text[start - 1].isalpha():
                start -= 1
            if start < at:
                out.append(text[start:at] + m[0].translate(_SIGN_TABLE))
    return out


@dataclass
class ToxicityModel:
    terms: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)  # intercept, hits, hits normalised by length

    def automaton(self):
        found = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            pattern = f" {term[:-1]}" if term.endswith("*") else f" {term} "
            found.add_word(pattern, (len(pattern) - 1, term, weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 1, None, 0.0))
        found.make_automaton()
        return found

    def features(self, texts, automaton) -> np.ndarray:
        """Weighted hits, and the same over the logarithm of the length, of each text."""
        out = np.zeros((len(texts), 2))
        for k, text in enumerate(texts):
            folded = fold(text)
            hits = list(automaton.iter(folded)) if len(automaton) else []
            if not hits:
                continue
            safe = [(end - size, end) for end, (size, term, _) in hits if term is None]  # with the blanks around
            times: dict[str, int] = {}
            total = 0.0
            for end, (size, term, weight) in hits:
                if term is not None and not any(a <= end - size and end <= b for a, b in safe):
                    times[term] = times.get(term, 0) + 1
                    total += weight / times[term]
            out[k] = total, total / np.log(np.e + folded.count(" "))
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + features @ np.array(self.weights[1:]), -500, 500)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Weights that are not negative (hits never make a text cleaner), by damped Newton steps."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hess = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, a.T @ (y - p) - ridge * w * np.array([0, *[1] * x.shape[1]]))
        w = w + np.clip(step, -2, 2)
        w[1:] = np.maximum(w[1:], 0)
    return tuple(map(float, w))


#: Near copies are told by min-hashes of five-word shingles: this many bands of two each.
BANDS = 8


def _bands(words: list[str]) -> list[int]:
    """One number per band; texts of similar shingles share some, others (almost) none."""
    grams = map(" ".join, zip(*(words[k:] for k in range(5)))) if len(words) > 4 else [" ".join(words)]
    hashes = np.fromiter(set(map(xxhash.xxh64_intdigest, grams)), np.uint64)
    least = [mix(hashes ^ mix(np.uint64([k]))).min() for k in range(2 * BANDS)]
    return [int(x) for x in pair(pair(np.array(least[::2]), np.array(least[1::2])), np.arange(BANDS, dtype=np.uint64)).view(np.int64)]


@F.pandas_udf(T.StructType([T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("words", T.ArrayType(T.StringType()))]))
def _folded_words(texts: pd.Series) -> pd.DataFrame:
    words = [fold(t).split() for t in texts]
    return pd.DataFrame({"bands": [_bands(w) for w in words], "words": words})


def _families(bands: list[list[int]]) -> list[int]:
    """For each text of the (bounded) sample the first one that it is connected to by shared bands."""
    label = list(range(len(bands)))

    def find(x: int) -> int:
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x
    first: dict[int, int] = {}
    for k, row in enumerate(bands):
        for band in row:
            x, y = find(first.setdefault(band, k)), find(k)
            label[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(bands))]


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> ToxicityModel:
    """Fit on at most ``max_train`` labelled documents of the training folds; terms are counted by Spark."""
    ids = labelled_sample(labels, "toxic", 4, 2, max_train)
    sample = one_per_id(docs.select("doc_id", whole_text(docs).alias("text")).join(F.broadcast(ids), "doc_id"), "y", "text")
    folded = sample.select("y", _folded_words("text").alias("f")).select("y", "f.bands", "f.words")
    folded = materialize(folded, "toxicity-sample")
    bands = sorted(map(list, {tuple(r.bands) for r in folded.select("bands").collect()}))
    family = docs.sparkSession.createDataFrame(list(zip(bands, _families(bands))), "bands array<long>, sig long")
    # one text per family: a toxic one if it has any
    folded = materialize(folded.join(F.broadcast(family), "bands").groupBy("sig").agg(F.max(F.struct("y", "words")).alias("t"))
                         .select("t.y", "t.words"), "toxicity-families")
    n = dict(folded.groupBy("y").count().collect())
    n1, n0 = n.get(1.0, 0), n.get(0.0, 0)
    if not n1 or not n0:
        return ToxicityModel(weights=(500.0 if n1 else -500.0, 0.0, 0.0))
    stems = F.transform(F.filter("words", lambda w: F.length(w) > STEM), lambda w: F.concat(F.left(w, F.lit(STEM)), F.lit("*")))
    terms = _weighted(folded.select("y", F.explode(F.array_distinct(F.concat("words", stems))).alias("term")), n1, n0) \
        .where((F.col("odds") > 1) & (F.col("evidence") >= MIN_EVIDENCE)) \
        .orderBy(F.desc("evidence"), "term").limit(MAX_TERMS).collect()
    found = {r.term: r for r in terms}
    # a word goes where its stem says more
    lexicon = {t: r.odds for t, r in found.items() if t.endswith("*") or (s := found.get(f"{t[:STEM]}*")) is None
               or len(t) <= STEM or s.evidence < r.evidence}
    listed = lambda w: w.isin(list(lexicon)) | F.concat(F.left(w, F.lit(STEM)), F.lit("*")).isin(list(lexicon))
    following = F.expr("slice(words, 2, greatest(size(words) - 1, 0))")
    near = folded.select("y", F.explode(F.array_distinct(F.filter(F.zip_with(
        "words", following, lambda a, b: F.when(b.isNotNull() & (listed(a) | listed(b)), F.concat(a, F.lit(" "), b))),
        lambda p: p.isNotNull()))).alias("term"))
    harmless = _weighted(near, n1, n0).where((F.col("d0") >= 3) & (F.col("odds") < 0)) \
        .orderBy(F.desc("d0"), "term").limit(MAX_EXCEPTIONS).collect() if lexicon else []
    model = ToxicityModel(lexicon, tuple(r.term for r in harmless))
    rows = sample.select("y", _features_of(model)("text").alias("f")).select("y", "f.*").toPandas()
    rows = rows.sort_values(["y", "hits", "dense"], ignore_index=True)
    model.weights = _logistic(rows[["hits", "dense"]].to_numpy(float), rows["y"].to_numpy(float))
    return model


def _weighted(rows: DataFrame, n1: int, n0: int) -> DataFrame:
    """term, texts of either label, log-odds, and the likelihood ratio statistic of its share; a row per text and term."""
    both = F.col("d1") + F.col("d0")
    gain = lambda d, n: F.when(d > 0, 2 * d * F.log(d * (n1 + n0) / (both * n))).otherwise(0.0)
    return rows.groupBy("term").agg(F.sum("y").alias("d1"), F.sum(1 - F.col("y")).alias("d0")).select(
        "term", "d1", "d0", (F.log((F.col("d1") + 0.5) / (n1 + 1)) - F.log((F.col("d0") + 0.5) / (n0 + 1))).alias("odds"),
        (gain(F.col("d1"), n1) + gain(F.col("d0"), n0)).alias("evidence"))


_FEATURES = T.StructType([T.StructField("hits", T.DoubleType()), T.StructField("dense", T.DoubleType())])


def _features_of(model: ToxicityModel):
    """An Arrow function from text to the two features; the model is bounded by its two limits."""
    state = {}

    @F.pandas_udf(_FEATURES)
    def features(texts: pd.Series) -> pd.DataFrame:
        if "automaton" not in state:
            state["automaton"] = model.automaton()
        return pd.DataFrame(model.features(texts, state["automaton"]), columns=["hits", "dense"])
    return features


def score_documents(docs: DataFrame, model: ToxicityModel, column: str = "score") -> DataFrame:
    b, w1, w2 = model.weights
    z = F.lit(b) + F.col("__llm_hits.hits") * F.lit(w1) + F.col("__llm_hits.dense") * F.lit(w2)
    return docs.withColumn("__llm_hits", _features_of(model)(whole_text(docs))) \
        .withColumn(column, F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).drop("__llm_hits")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return score_documents(docs, model).select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"))
