"""Statistics, scores and verdicts of operators 2, 4 and 5 against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from streamload.llm import quality_classifier, quality_rules, toxicity

SF = "/root/testdata/sf0.01"
ODD = [None, "", " \n", "one", "A! " * 40, "été über 日本 " * 30, "12 34|56 #$%" * 30, "a\n\nb\na\n" * 20, "\x0b\x0c\t x", "Ab" * 9000]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6 + k, t, lang, None, None) for k, t in enumerate(ODD) for lang in ("en", None, "xx")],
                                "doc_id long, text string, lang string, source string, n_chars long")
    return df.unionByName(odd.select(*df.columns)).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "", r.lang) for r in docs.collect()]


# --------------------------------------------------------------------------- operator 2

def plain_distance(p, q):
    if not sum(p) or not sum(q):
        return None
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    half = [sum(a * math.log2(a / c) for a, c in zip(x, m) if a) for x in (p, q)]
    return math.sqrt(max(sum(half) / 2, 0.0))


def test_verdicts_of_operator_2(docs, rows):
    common = quality_rules.COMMON
    sums_chars, sums_words, found = defaultdict(Counter), defaultdict(Counter), []
    for _, text, lang in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        n_words, _, _, _, repeated = brute.base_counts(text)
        failed = n_words < 20 or 100 * repeated > 30 * n_words

        def kind(c):
            if "A" <= c <= "Z":
                return "upper"
            if "0" <= c <= "9":
                return "digit"
            if c in ".,;:!?'\"()-":
                return "punct"
            if c in "#*$%&|<>":
                return "symbol"
            return "blank" if c in " \t\n\v\f\r" else "beyond" if ord(c) >= 128 else "lower"
        chars = Counter(map(kind, text))
        lang = lang if lang in common else "other"
        listed = Counter(w.lower() for w in words if w.lower() in common.get(lang, ()))
        listed["(rest)"] = len(words) - sum(listed.values())
        found.append((failed, lang, chars, listed, len(text), len(words)))
        if not failed:
            sums_words[lang].update(listed)
            for name in (lang, "(all)"):
                sums_chars[name].update(chars)
    want = []
    for (doc, text, _), (failed, lang, chars, listed, n_chars, n_words) in zip(rows, found):
        ref = sums_chars["(all)" if lang == "other" else lang]
        keys = sorted(set(ref) | set(chars))
        far = n_chars >= quality_rules.MIN_CHARS_JUDGED and plain_distance([chars[k] for k in keys], [ref[k] for k in keys])
        far = bool(far) and far > quality_rules.MAX_CHAR_DISTANCE
        if n_words >= quality_rules.MIN_WORDS_JUDGED and lang != "other":
            keys = sorted(set(sums_words[lang]) | set(listed))
            d = plain_distance([listed[k] for k in keys], [sums_words[lang][k] for k in keys])
            far = far or (d is not None and d > quality_rules.MAX_WORD_DISTANCE)
        want.append((doc, failed, not failed and not far))
    got = [(r.doc_id, r.base_failed, r.kept) for r in quality_rules.judge(docs).collect()]
    assert sorted(got) == sorted(want)
    assert any(not f and not k for _, f, k in want)  # the method rejects what the base rules keep


# --------------------------------------------------------------------------- operator 4

def test_folding_reads_signs_at_the_end_both_ways():
    def words(text):
        return toxicity.fold(text).split()
    assert words("idio7") == ["idio", "idiot"] and words("worthle55, x") == ["worthie", "x", "worthiess"]
    assert words("h4t3") == ["hat", "hate"] and words("a$$") == ["a", "ass"]
    assert words("idiot$$ now") == ["idiot", "now", "idiotss"] and words("what!!! no!") == ["what", "no"]
    assert words("1d10t") == words("idiot") and words("h0000t") == words("hoooot")  # any run inside a word
    assert words("room 101 costs 5$ in 2017") == ["room", "costs", "in"]


def plain_features(text, model):
    folded = toxicity.fold(text)
    safe = []
    for phrase in model.exceptions:
        safe += [(m.start(), m.start() + len(phrase) + 2) for m in re.finditer(f"(?= {re.escape(phrase)} )", folded)]
    total, times = 0.0, Counter()
    hits = []
    for term, weight in model.terms.items():
        pattern = f" {term[:-1]}" if term.endswith("*") else f" {term} "
        hits += [(m.start(), m.start() + len(pattern), term, weight) for m in re.finditer(f"(?={re.escape(pattern)})", folded)]
    for a, b, term, weight in hits:
        if not any(x <= a and b <= y for x, y in safe):
            times[term] += 1
            total += weight / times[term]
    return total, total / math.log(math.e + folded.count(" "))


def test_scores_of_operator_4(spark, docs, rows):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, labels)
    assert model.terms
    b, w1, w2 = model.weights
    got = {r.doc_id: [] for r in docs.select("doc_id").collect()}
    for r in toxicity.score_documents(docs, model).select("doc_id", "score").collect():
        got[r.doc_id].append(r.score)
    want = defaultdict(list)
    for doc, text, _ in rows:
        hits, dense = plain_features(text, model)
        want[doc].append(1 / (1 + math.exp(-(b + w1 * hits + w2 * dense))))
    assert all(sorted(got[d]) == pytest.approx(sorted(want[d])) for d in got)


def test_features_with_exceptions_and_stems():
    r = random.Random(4)
    model = toxicity.ToxicityModel({"idiot": 2.0, "worthi*": 1.5, "kiii": 0.7}, ("idiot proof", "the kiii", "kiii time"), (-1.0, 1.0, 0.5))
    vocabulary = ["idiot", "proof", "worthless", "kill", "time", "the", "1diot", "kil1", "idio7", "x"]
    texts = ["", *(" ".join(r.choices(vocabulary, k=r.randint(1, 30))) for _ in range(300))]
    got = model.features(texts, model.automaton())
    for text, f in zip(texts, got):
        assert tuple(f) == pytest.approx(plain_features(text, model))


@pytest.mark.parametrize("op", [toxicity, quality_classifier])
def test_models_do_not_depend_on_order_or_repeated_ids(spark, op):
    """Ids that are in the table many times, with other texts, are one row of the sample, in whatever order they come."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    again = docs.unionByName(docs).unionByName(docs.filter("doc_id % 3 = 0").withColumn("text", F.concat("text", F.lit(" zz"))))
    found = [op.train(df, labels, max_train=150) for df in (docs, again.repartition(7), again.orderBy(F.desc("doc_id")).coalesce(2))]
    assert found[0] == found[1] == found[2]


# --------------------------------------------------------------------------- operator 5

def plain_statistics(text):
    raw = text.encode()
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, n_bytes = max(len(words), 1), max(len(raw), 1)

    def count(pattern):
        return len(re.findall(pattern, raw))
    seen = Counter(words)
    return {"log_words": math.log1p(len(words)), "mean_word": sum(len(w) for w in words) / n,
            "upper_share": count(rb"[A-Z]") / max(count(rb"[A-Za-z]"), 1), "symbol_share": count(rb"[#*$%&|<>]") / n_bytes,
            "bang_share": count(rb"!") / n, "pipe_share": count(rb"\|") / n, "digit_share": count(rb"[0-9]") / n_bytes,
            "punct_share": count(rb"[.,;:!?'\"()-]") / n, "distinct_share": len(seen) / n,
            "top_word_share": max(seen.values(), default=0) / n, "neighbour_share": sum(a == b for a, b in zip(words, words[1:])) / n,
            "line_words": n / max(len(lines), 1), "repeat_line_share": 1 - len(set(lines)) / max(len(lines), 1),
            "high_byte_share": count(rb"[\x80-\xff]") / n_bytes}


def test_statistics_and_scores_of_operator_5(spark, docs, rows):
    model = quality_classifier.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert model.rules
    text = F.coalesce("text", F.lit(""))
    out = quality_classifier.score_documents(docs, model).select(
        text.alias("text"), quality_classifier.text_statistics(text).alias("s"), "score").collect()
    for r in out:
        want = plain_statistics(r.text)
        assert r.s.asDict() == pytest.approx(want), r.text[:60]
        values = [want[name] for name in quality_classifier.STATISTICS]
        z = model.intercept + sum(w for rule, w in zip(model.rules, model.weights)
                                  if all((values[j] > cut) == up for j, up, cut in rule))
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)))
