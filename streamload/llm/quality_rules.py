"""Quality rules with distribution divergence, in DataFrame functions only (operator 2).

Base rules count words, symbols, repeated lines and words in repeated eight-word windows.  On top of them a
document is compared with its language: the histogram of its characters over classes, and of its words over the
language's common words, against the same histograms summed over all documents that pass the base rules.  The
measure is the Jensen-Shannon distance (base 2, 0 to 1); short texts are not judged by it.

Per-document counts are written once, without texts; the references are one aggregation over them and have
one row per known language and one for all others, which is why they may be broadcast.

Defined results: null and empty text have no words and fail the base rules; the characters of rows of null or unknown
language are compared with those of all languages together, their words are not judged; a language whose reference is empty
is not judged; repeated rows are judged each on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, materialize, table, whole_text

MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
#: Length guards: code points for the character histogram, words for the word histogram.
MIN_CHARS_JUDGED, MIN_WORDS_JUDGED = 200, 100
#: Clean prose stays below 0.24 on either; tables, shouting and symbol noise lie at 0.25 to 0.4.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.25, 0.25

# Frequent function words of each language.
COMMON = {
    "en": "the of and to in a is that for it as was on with".split(),
    "de": "der die und in den von zu das mit sich des auf für ist".split(),
    "fr": "de la le et les des en un du une que est pour qui".split(),
    "es": "de la que el en y a los se del las un por con".split(),
}
CLASSES = ("lower", "upper", "digit", "blank", "punct", "symbol", "beyond_ascii")


def _only(text: Column, kept: str) -> Column:
    """How many code points of the class ``kept`` (the inside of a bracket) the text has."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", ""))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, whatever the body does with it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(hashes: Column, window: int) -> Column:
    """Words covered by windows whose hash occurs twice or more among ``hashes``."""
    in_order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = _let(in_order, lambda s: F.sort_array(F.filter(F.transform(s, lambda x, k: F.when(
        (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])), lambda i: i.isNotNull())))
    covered = _let(repeated, lambda p: F.aggregate(F.transform(p, lambda i, k: F.when(
        k > 0, F.least(F.lit(window), i - F.get(p, k - 1))).otherwise(F.lit(window))), F.lit(0), lambda a, b: a + b))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered)


def document_counts(docs: DataFrame) -> DataFrame:
    """doc_id, language group, the base counts and both histograms of every row."""
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    base = docs.select("doc_id", F.when(lang.isin(list(COMMON)), lang).otherwise("other").alias("lang"),
                       whole_text(docs).alias("text"))
    split = base.select("*", F.array_remove(F.split("text", BLANKS), "").alias("words"),
                        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    lists = {k: F.array(*map(F.lit, v)) for k, v in COMMON.items()}
    own = F.coalesce(*[F.when(F.col("lang") == k, v) for k, v in lists.items()],
                     F.array(*map(F.lit, sorted(set().union(*COMMON.values())))))
    every = sorted(set().union(*COMMON.values()))
    counted = split.select(
        "doc_id", "lang", F.size("words").alias("n_words"), F.length(F.array_join("words", "")).alias("word_chars"),
        F.length("text").alias("n_chars"), _only(F.col("text"), r"#*$%&|<>").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(F.size("words") >= REPEAT_WINDOW, F.transform(
            F.sequence(F.lit(1), F.size("words") - (REPEAT_WINDOW - 1)),
            lambda i: F.xxhash64(F.slice("words", i, REPEAT_WINDOW)))).alias("windows"),
        _only(F.col("text"), "A-Z").alias("upper"), _only(F.col("text"), "0-9").alias("digit"),
        _only(F.col("text"), r".,;:!?'\x22()\-").alias("punct"),
        _only(F.col("text"), r"\x{80}-\x{10FFFF}").alias("beyond_ascii"),
        F.filter(F.transform("words", F.lower), lambda w: w.isin(every)).alias("common"), own.alias("list"))
    classes = {"upper": F.col("upper"), "digit": F.col("digit"), "blank": F.col("n_chars") - F.col("word_chars"),
               "punct": F.col("punct"), "symbol": F.col("n_symbols"), "beyond_ascii": F.col("beyond_ascii")}
    classes["lower"] = F.col("n_chars") - sum(classes.values(), F.lit(0))
    in_list = counted.select(
        "*", F.array(*[classes[c].cast("double") for c in CLASSES]).alias("chars"),
        F.transform("list", lambda y: F.size(F.filter("common", lambda x: x == y)).cast("double")).alias("hits"))
    return in_list.select(
        "doc_id", "lang", *[F.col(c).cast("long") for c in ("n_words", "word_chars", "n_chars", "n_symbols", "n_dup_lines")],
        F.coalesce(_repeat_words(F.col("windows"), REPEAT_WINDOW), F.lit(0)).cast("long").alias("n_repeat_words"), "chars",
        F.concat("hits", F.array(F.col("n_words") - F.aggregate("hits", F.lit(0.0), lambda a, b: a + b))).alias("commons"))


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two count arrays of one length; null if either is all zero."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, b: a + b)
    part = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)
    share = lambda x: _let(total(x), lambda n: F.transform(x, lambda y: y / n))
    parts = F.zip_with(share(p), share(q), lambda a, b: (part(a, b) + part(b, a)) / 2)
    return F.when((total(p) > 0) & (total(q) > 0), F.sqrt(F.greatest(total(parts), F.lit(0.0))))


def references(counts: DataFrame) -> DataFrame:
    """Summed histograms of the documents that pass the base rules, one row per language group.

    ``other`` stands for unknown languages; its character reference is that of all documents.
    """
    good = counts.where(~F.col("base_failed"))
    sums = lambda c, n: F.array(*[F.coalesce(F.sum(F.get(c, F.lit(k))), F.lit(0.0)) for k in range(n)])
    most = max(max(map(len, COMMON.values())), len(set().union(*COMMON.values()))) + 1
    by_lang = good.groupBy("lang").agg(sums("chars", len(CLASSES)).alias("ref_chars"), sums("commons", most).alias("ref_wide"))
    of_all = good.agg(sums("chars", len(CLASSES)).alias("all_chars"))
    known = counts.sparkSession.createDataFrame(
        [(k, len(v) + 1) for k, v in COMMON.items()] + [("other", most)], "lang string, bins int")
    return known.join(by_lang, "lang", "left").crossJoin(F.broadcast(of_all)).select(
        "lang", F.when(F.col("lang") == "other", F.col("all_chars")).otherwise(F.col("ref_chars")).alias("ref_chars"),
        F.slice("ref_wide", F.lit(1), F.col("bins")).alias("ref_commons"))


def judge(docs: DataFrame, max_char_distance: float = MAX_CHAR_DISTANCE,
          max_word_distance: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Base counts, base_failed, both distances (null where not judged) and kept, one row per input row."""
    counts = document_counts(docs)
    counts = materialize(counts.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))), "quality-counts")
    judged = counts.join(F.broadcast(references(counts)), "lang", "left")
    judged = judged.select(
        "*", F.when(F.col("n_chars") >= MIN_CHARS_JUDGED, _distance(F.col("chars"), F.col("ref_chars"))).alias("char_distance"),
        F.when((F.col("n_words") >= MIN_WORDS_JUDGED) & (F.col("lang") != "other"),
               _distance(F.col("commons"), F.col("ref_commons"))).alias("word_distance"))
    far = (F.coalesce(F.col("char_distance") > max_char_distance, F.lit(False))
           | F.coalesce(F.col("word_distance") > max_word_distance, F.lit(False)))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & ~far).alias("kept"), "char_distance", "word_distance")


def op2_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
