"""Personal data by patterns and by information-theoretic sanitisation, in DataFrame functions only (operator 8).

Base spans are e-mail addresses, IP addresses, card and phone numbers.  A protected entity is the text of such a
span without case (e-mail) or without all but its digits (card, phone).  The corpus tells how strongly a word reveals an
entity, by the documents that hold both: ``pmi(t; e) = log2(n(t, e) * N / (n(t) * n(e)))``, against the entity's
information content ``ic(e) = log2(N / n(e))``; all counts are of whole documents.  A word with
``pmi >= disclosure * ic`` is revealing, and each of its occurrences in every document that holds the entity gets a span of
kind ``term``.

Copies of a text say nothing about its words.  So a word counts for an entity only if it is in ``support`` documents or
more, and if both what stands before it and what stands after it (``AROUND`` words) differ in ``support`` places or more and
in at least half as many as there are documents.  The words of copies, exact or near, stand between the same ones; those
beside a word that was changed, on one side.

What moves is little.  Only entities in ``support`` documents can have a term, so these are counted first, and only the
documents that hold one of them are taken apart into words; a table without such entities ends there.  The vocabulary of
all documents is counted for the candidates alone.  What is written in between are hashes and places, no text.

The patterns are written with possessive repeats and start only where a run starts (or where the match before
ended), which gives the same leftmost matches without backtracking over long runs.

Defined results: null and empty text have no spans; rows of equal doc_id and text are one document;
rows without doc_id are handled like others; spans are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, materialize, table, whole_text

KINDS = ("email", "ip", "card", "phone", "term")
_EMAIL_CHAR, _DOMAIN_CHAR = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_EMAIL_CHAR})){_EMAIL_CHAR}++@{_DOMAIN_CHAR}++(?:\.{_DOMAIN_CHAR}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SUPPORT, DISCLOSURE, MIN_TERM, AROUND = 3, 0.8, 3, 3
#: Candidate terms and entities that are sent to all tasks (16 bytes each); with more, they are joined.
MAX_BROADCAST = 100_000
_SPANS = "array<struct<start:int,rank:int,end:int,value:string>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, whatever the body does with it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _before(numbers: Column, group: int = 64) -> Column:
    """Sum of the numbers before each; in groups, so that many numbers cost little more than their count."""
    def of_groups(parts: Column) -> Column:
        return _let(F.transform(parts, _sum), lambda sums: F.flatten(F.transform(parts, lambda x, k: _let(
            _sum(F.slice(sums, F.lit(1), k)),
            lambda base: F.transform(x, lambda y, i: base + _sum(F.slice(x, F.lit(1), i)))))))
    return _let(numbers, lambda every: _let(F.transform(
        F.sequence(F.lit(0), F.floor((F.size(every) - 1) / group).cast("int")),
        lambda k: F.slice(every, k * group + 1, group)), of_groups))


def _spans(text: Column, pattern: str, kind: int) -> Column:
    """Matches of the pattern as spans: what lies between the matches tells where they start."""
    def placed(pairs: Column) -> Column:
        lengths = F.transform(pairs, lambda p: F.length(p["between"]) + F.length(p["value"]))
        return F.zip_with(pairs, _before(lengths), lambda p, at: F.struct(
            (at + F.length(p["between"])).alias("start"), F.lit(kind).alias("rank"),
            (at + F.length(p["between"]) + F.length(p["value"])).alias("end"), p["value"].alias("value")))

    def found(t: Column) -> Column:
        pairs = _let(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda values: F.zip_with(
            values, F.slice(F.split(t, pattern), F.lit(1), F.size(values)),
            lambda v, b: F.struct(b.alias("between"), v.alias("value"))))
        return F.when(t.rlike(pattern), _let(pairs, placed)).otherwise(F.array().cast(_SPANS))
    return _let(text, found)


def _blanked(text: Column, spans: Column) -> Column:
    """The text with blanks in place of the spans (which are in order and do not overlap)."""
    def of(t: Column, s: Column) -> Column:
        end = lambda k: F.coalesce(F.get(s, k)["end"], F.lit(0))
        parts = F.transform(s, lambda x, k: F.concat(F.substring(t, end(k - 1) + 1, x["start"] - end(k - 1)),
                                                     F.repeat(F.lit(" "), x["end"] - x["start"])))
        return F.concat(F.array_join(parts, ""), F.substring(t, end(F.size(s) - 1) + 1, F.length(t)))
    return _let(text, lambda t: _let(spans, lambda s: of(t, s)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def _luhn(value: Column) -> Column:
    figures = F.transform(F.split(F.reverse(_digits(value)), ""), lambda x: x.try_cast("int"))
    each = F.transform(figures, lambda d, k: F.when(k % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    n = F.length(_digits(value))
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(value)).otherwise(F.lit(False))
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def _keeps(kind: str):
    return lambda span: _valid(kind, span["value"])


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, key (hash of the text), text, spans (valid ones of all base kinds by start and kind)."""
    text = whole_text(docs)
    found = docs.select("doc_id", F.xxhash64(text).alias("key"), text.alias("text"), *[
        _spans(text, p, KINDS.index(kind)).alias(f"s_{kind}") for kind, p in PATTERNS.items()])
    valid = [F.filter(f"s_{kind}", _keeps(kind)) for kind in PATTERNS]
    return found.select("doc_id", "key", "text", F.sort_array(F.concat(*valid)).alias("spans"))


def _of_kind(rank: int):
    return lambda span: span["rank"] == rank


def _words_at(text: Column, base: Column) -> Column:
    """Words of a piece of text that starts at ``base``, with their place."""
    return F.transform(_spans(text, r"[^\x20\x09-\x0D]++", KINDS.index("term")), lambda s: F.struct(
        (s["start"] + base).alias("start"), (s["end"] + base).alias("end"), s["value"].alias("value")))


def _term(value: Column) -> Column:
    """The word without the punctuation around it, lower case."""
    return F.lower(F.regexp_replace(value, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= MAX_BROADCAST else df


def _document(doc_id: str = "doc_id") -> Column:
    """A name of the row's document that is never null; with the text's hash it tells documents apart."""
    return F.coalesce(F.concat(F.lit("="), F.col(doc_id).cast("string")), F.lit("-"))


def _entity(span: Column) -> Column:
    """The hash of what a span names, without case and separators."""
    value, rank = span["value"], span["rank"]
    digits = rank.isin(KINDS.index("card"), KINDS.index("phone"))
    return F.xxhash64(rank, F.when(digits, _digits(value)).otherwise(F.lower(value)))


def words_of_holders(docs: DataFrame, holding: DataFrame) -> DataFrame:
    """doc, key, term, before, after (hashes of the word and of the words around it), start, end of every word of the
    documents in ``holding``; personal data of any kind is blanked first, so only other words are terms."""
    keyed = docs.select("doc_id", "text", _document().alias("doc"), F.xxhash64(whole_text(docs)).alias("key"))
    held = keyed.join(holding.select("doc", "key").distinct(), ["doc", "key"], "left_semi")
    found = base_spans(held.select(F.col("doc").alias("doc_id"), "text")).dropDuplicates(["doc_id", "key"])
    for kind in range(len(PATTERNS)):
        found = found.withColumn("text", _blanked(F.col("text"), F.filter("spans", _of_kind(kind))))
    words = found.select(F.col("doc_id").alias("doc"), "key", _words_at(F.col("text"), F.lit(0)).alias("words"))
    words = words.select("doc", "key", F.transform("words", lambda w: F.struct(
        _term(w["value"]).alias("term"), w["start"].alias("start"), w["end"].alias("end"))).alias("words"))
    def near(steps, i):
        return F.xxhash64(*[F.coalesce(F.get(F.col("words"), i + k)["term"], F.lit("\u0000")) for k in steps])
    words = words.select("doc", "key", F.explode(F.transform("words", lambda w, i: F.struct(
        w["term"].alias("term"), near(range(-AROUND, 0), i).alias("before"), near(range(1, AROUND + 1), i).alias("after"),
        w["start"].alias("start"), w["end"].alias("end")))).alias("w"))
    return words.where((F.length("w.term") >= MIN_TERM) & F.col("w.term").rlike(r"\p{L}")) \
        .select("doc", "key", F.xxhash64("w.term").alias("term"), "w.before", "w.after", "w.start", "w.end")


def revealing_terms(docs: DataFrame, holding: DataFrame, words: DataFrame, support: int, disclosure: float) -> DataFrame | None:
    """(entity, term) whose pointwise mutual information reaches the disclosure threshold; None if no pair is a candidate.

    ``holding`` has doc, key, entity and n_e; ``words`` comes from :func:`words_of_holders`.
    """
    place = F.struct("doc", "key")
    seen = words.select("doc", "key", "term", "before", "after").distinct().join(holding, ["doc", "key"])
    joint = seen.groupBy("entity", "n_e", "term").agg(
        F.countDistinct(place).alias("n_te"), F.least(F.countDistinct("before"), F.countDistinct("after")).alias("seen")) \
        .where((F.col("n_te") >= support) & (F.col("seen") >= support) & (2 * F.col("seen") >= F.col("n_te")))
    joint = materialize(joint, "private-joint")
    candidates = joint.select("term").distinct()
    n = candidates.count()
    if not n:
        return None
    text = whole_text(docs)
    named = docs.select(_document().alias("doc"), F.xxhash64(text).alias("key"), text.alias("text"))
    rows = named.groupBy("doc", "key").agg(F.count(F.lit(1)).alias("rows"))
    total = rows.count()
    repeated = materialize(rows.where("rows > 1").select("doc", "key"), "private-repeated")

    def counted(part: DataFrame, number: Column) -> DataFrame:
        every = part.select("doc", "key", F.explode(F.array_distinct(F.transform(
            F.split("text", BLANKS), lambda w: F.xxhash64(_term(w))))).alias("term"))
        return every.join(_small(candidates, n), "term").groupBy("term").agg(number.alias("n_t"))
    n_repeated = repeated.count()
    if not n_repeated:  # a row is a document, so counts are added up before they move
        frequency = counted(named, F.count(F.lit(1)))
    else:
        again = _small(repeated, n_repeated)
        frequency = counted(named.join(again, ["doc", "key"], "left_anti"), F.count(F.lit(1))).unionByName(
            counted(named.join(again, ["doc", "key"], "left_semi"), F.countDistinct(place))) \
            .groupBy("term").agg(F.sum("n_t").alias("n_t"))
    pmi = F.log2(F.col("n_te") * F.lit(float(total)) / (F.col("n_t") * F.col("n_e")))
    return joint.join(_small(frequency, n), "term").where(
        (F.col("n_e") < total) & (pmi >= disclosure * F.log2(F.lit(float(total)) / F.col("n_e")))).select("entity", "term")


def find_private(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """doc_id, key, base (spans of the base kinds) and spans (with the method's terms), one row per input row."""
    found = base_spans(docs).select("doc_id", "key", F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), _entity(s).alias("entity"))).alias("spans"))
    found = materialize(found, "private-spans")
    spans = found.select("doc_id", "key", F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"))).alias("base"))
    alone = spans.select("doc_id", "key", "base", F.col("base").alias("spans"))
    holders = found.select(_document().alias("doc"), "key", F.explode(F.array_distinct(F.transform(
        "spans", lambda s: s["entity"]))).alias("entity")).distinct()
    entities = materialize(holders.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).where(F.col("n_e") >= support), "private-entities")
    n = entities.count()
    if not n:
        return alone
    holding = materialize(holders.join(_small(entities, n), "entity"), "private-holding")
    words = materialize(words_of_holders(docs, holding), "private-words")
    revealing = revealing_terms(docs, holding, words, support, disclosure)
    if revealing is None:
        return alone
    pairs = holding.join(revealing, "entity").select("doc", "key", "term").distinct()
    by_doc = words.join(pairs, ["doc", "key", "term"]).groupBy(F.col("doc").alias("t_doc"), F.col("key").alias("t_key")).agg(
        F.collect_list(F.struct("start", F.lit(KINDS.index("term")).alias("rank"), "end")).alias("terms"))
    return spans.withColumn("t_name", _document()).join(
        by_doc, (F.col("t_name") == F.col("t_doc")) & (F.col("key") == F.col("t_key")), "left").select(
        "doc_id", "key", "base", F.sort_array(F.when(F.col("terms").isNull(), F.col("base"))
                                              .otherwise(F.concat("base", "terms"))).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kind, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first stays."""
    kind = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    step = lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(
        F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(kind, s["rank"])).alias("out"),
        s["end"].alias("at"))).otherwise(acc)
    return F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step,
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def op8_private_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_private(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["rank"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", *[count(k) for k in range(4)], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
