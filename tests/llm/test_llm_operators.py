"""Operators against plain versions: on a table of edge cases and on the small documents table."""

import json
import os
import random
import subprocess
import sys
from collections import Counter

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

from streamload.llm import (decontamination, line_dedup, packing, private_terms, quality_classifier, quality_rules, repeats,
                            simhash, substring_dedup, suffix_dedup, toxicity)
from streamload.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
EXTRA = "score double, h long, key long, block int, words string, spans int, label string, n_words long, bucket int"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh ioue") for _ in range(r.randint(2, 9))).strip() or "x" for _ in range(n))


def edge_rows():
    """(doc_id, text): nulls, empty, short, long, copies, near copies, shared passages, ties, repeated rows."""
    a, b, c = prose(1, 400), prose(2, 120), prose(3, 60)
    lines = "\n".join(prose(k, 9) for k in range(8))
    rows = [(5, a), (3, a), (9, a.replace("a", "A", 1)), (1, b + " " + c), (2, c + "\n" + b), (4, None), (6, ""), (7, "one"),
            (8, " \t\n"), (10, "Shti " * 300), (11, "x" * 5000), (12, lines), (13, prose(9, 20) + "\n" + lines + "\nend"),
            (14, lines + "\n" + lines), (15, "été  über naïve " * 30), (16, b), (16, b), (None, b), (None, prose(5, 90)),
            (17, "a\n\n\n\n\n\nb"), (18, prose(7, 3000)), (19, prose(7, 3000)[:9000]), (20, "ab\x00cd " * 40)]
    return rows


@pytest.fixture(scope="module")
def edge(spark):
    rows = edge_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long"),
                           **{c.split()[0]: F.lit(None).cast(c.split()[1]) for c in EXTRA.split(", ")}}), rows


@pytest.fixture(scope="module")
def small(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    return df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("table", ["edge", "small"])
def test_suffix_dedup(table, request):
    docs, rows = request.getfixturevalue(table)
    if table == "small":
        rows = [(d, t) for d, t in rows]
    out = suffix_dedup.drop_repeated_bytes(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")), F.size("spans"), F.sha2("kept", 256))
    assert rows_of(out) == sorted(brute.substring_bytes(rows), key=repr)


def own_and_shared(n):
    """Texts that share two passages (of bytes and of words), each between words of its own."""
    shared = [prose(901, 14), prose(902, 60)]
    return [(k, " ".join([prose(1000 + k, 30), shared[0], prose(5000 + k, 40), shared[1], prose(9000 + k, 30)])) for k in range(n)]


@pytest.mark.parametrize("table,grams", [("edge", 10**6), ("small", 10**6), ("shared", 10**6), ("shared", 0), ("edge", 0)])
def test_suffix_dedup_with_frequent_anchors(table, grams, request, spark, monkeypatch):
    """All levels of dealing give the same result, also where there are too many frequent grams to tell them."""
    monkeypatch.setattr(suffix_dedup, "MAX_GRAMS", grams)
    rows = own_and_shared(30)
    docs, rows = request.getfixturevalue(table) if table != "shared" else (spark.createDataFrame(rows, "doc_id long, text string"), rows)
    found = suffix_dedup.frequent_grams(docs, 1, 2, 1)
    assert found is None if grams == 0 else len(found)
    out = suffix_dedup.drop_repeated_bytes(docs, 2, 1).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")), F.size("spans"), F.sha2("kept", 256))
    assert rows_of(out) == sorted(brute.substring_bytes(rows), key=repr)


def test_suffix_dedup_bounds_what_one_key_deals(spark):
    """The edges of a passage in every document, which differ in each, do not go to one shard, and their anchors, which
    differ in each too, not to one bucket."""
    import numpy as np
    import pyarrow as pa
    n = 300
    rows = own_and_shared(n)
    texts = pa.table({"block": pa.array([0] * n, pa.int32()), "doc_id": [k for k, _ in rows], "text": [t for _, t in rows]})

    def most(frequent):
        grams = suffix_dedup.frequent_grams(spark.createDataFrame(rows, "doc_id long, text string"), 1, frequent, 1)
        first = suffix_dedup._first_level(texts, grams)
        found = spark.createDataFrame(first.to_pandas(), "block int, kind int, h long, n int")
        again = suffix_dedup.repeated_keys(found, 1, frequent).toArrow()
        out = suffix_dedup._surroundings(texts, again, 1 << 20, grams)
        bucket = out.filter(pa.array(~out["known"].to_numpy()))["bucket"].to_numpy()
        kind, h = first["kind"].to_numpy(), first["h"].to_numpy().view(np.uint64)
        whole = np.unique(h[kind == 0] >> np.uint64(32), return_counts=True)[1]
        return np.unique(bucket, return_counts=True)[1].max(), whole.max()
    surroundings, anchors = most(8)
    assert surroundings <= 16 and anchors <= 8
    surroundings, anchors = most(2 * n)
    assert surroundings > n // 2 and anchors > n // 2


def test_frequent_grams_are_told_from_a_sample(spark):
    """A gram of every text is found in one text of eight; one of few texts is not."""
    rows = [(k, f"{prose(3000 + k, 20)} the common words that all of these texts have in the middle {prose(7000 + k, 20)}") for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    every = set(suffix_dedup.frequent_grams(docs, 1, 400, 1).tolist())
    some = set(suffix_dedup.frequent_grams(docs, 1, 400, 8).tolist())
    assert every and every <= some
    assert len(suffix_dedup.frequent_grams(docs, 1, 10_000, 8)) == 0


def test_suffix_order_is_lexicographic():
    import numpy as np
    r = random.Random(4)
    for n in (1, 2, 3, 60, 700):
        raw = bytes(r.choice(b"ab") for _ in range(n)) * 2
        text = np.frombuffer(raw, np.uint8)
        order = suffix_dedup.suffix_order(text, np.arange(len(raw)))
        key = [raw[p:p + 50] for p in order]
        pad = lambda s: s.ljust(50, b"\0")
        assert sorted(order) == list(range(len(raw))) and [pad(k) for k in key] == sorted(map(pad, key))


@pytest.mark.parametrize("table", ["edge", "small"])
def test_substring_dedup(table, request):
    docs, rows = request.getfixturevalue(table)
    out = substring_dedup.drop_repeated_windows(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256))
    assert rows_of(out) == sorted(brute.substring_words(rows), key=repr)


@pytest.mark.parametrize("table", ["edge", "small", "shared"])
def test_substring_dedup_with_frequent_anchors(table, request, spark):
    """Windows dealt alone give the same result."""
    rows = own_and_shared(30)
    docs, rows = request.getfixturevalue(table) if table != "shared" else (spark.createDataFrame(rows, "doc_id long, text string"), rows)
    out = substring_dedup.drop_repeated_windows(docs, 2).select("doc_id", "n_words", "n_removed", F.sha2("text", 256))
    assert rows_of(out) == sorted(brute.substring_words(rows), key=repr)


def test_substring_dedup_bounds_what_one_key_deals(spark):
    """The edges of a passage in every document, which differ in each, do not go to one bucket."""
    import numpy as np
    import pyarrow as pa
    n = 300
    rows = own_and_shared(n)
    texts = pa.table({"block": pa.array([0] * n, pa.int32()), "doc_id": [k for k, _ in rows], "text": [t for _, t in rows]})
    found = spark.createDataFrame(substring_dedup._first_level(texts).to_pandas(), "block int, h long, n int")

    def most(frequent):
        again = repeats.repeated_anchors(found, 1, limit=frequent).toArrow()
        out = substring_dedup._extend(texts, again, 1 << 20)
        bucket = out.filter(pa.array(~out["known"].to_numpy()))["bucket"].to_numpy()
        return np.unique(bucket, return_counts=True)[1].max()
    assert most(8) <= 16 and most(n) > n // 2


def test_blocks_and_shards_do_not_change_results(edge, monkeypatch):
    docs, rows = edge
    for module in (suffix_dedup, substring_dedup):
        monkeypatch.setattr(module, "BLOCK_BYTES", 4000)
        monkeypatch.setattr(module, "SHARD_BYTES", 5000)
    out = substring_dedup.drop_repeated_windows(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256))
    assert rows_of(out) == sorted(brute.substring_words(rows), key=repr)
    out = suffix_dedup.drop_repeated_bytes(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")), F.size("spans"), F.sha2("kept", 256))
    assert rows_of(out) == sorted(brute.substring_bytes(rows), key=repr)


@pytest.mark.parametrize("table", ["edge", "small"])
def test_simhash(table, request):
    docs, rows = request.getfixturevalue(table)
    out = simhash.near_duplicates(docs).select("doc_id", simhash.hex16(F.col("fp")), "component_id")
    assert rows_of(out) == sorted(brute.near_duplicates(rows), key=repr)


def test_bk_forest_finds_every_neighbour(spark):
    import numpy as np
    r = np.random.default_rng(3)
    centre = r.integers(0, 1 << 62, 6, dtype=np.uint64)
    values = np.unique([int(c) ^ sum(1 << int(b) for b in r.integers(0, 64, k % 6)) for c in centre for k in range(150)])
    values = values.astype(np.uint64)
    tree = (values % np.uint64(3)).astype(np.int64)
    forest = simhash.BKForest(values, tree)
    at, to = forest.search(values, np.searchsorted(np.unique(tree), tree), 3)
    got = set(zip(at.tolist(), to.tolist()))
    want = {(i, j) for i in range(len(values)) for j in range(len(values))
            if tree[i] == tree[j] and (int(values[i]) ^ int(values[j])).bit_count() <= 3}
    assert got == want


def brute_components(fps):
    """Smallest member of the component of every fingerprint, by comparing all."""
    import numpy as np
    values = np.array(sorted(fps), dtype=np.uint64)
    label = np.arange(len(values))
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= 3) for v in values]
    while True:
        new = np.array([label[n].min() for n in near])
        new = new[new]
        if (new == label).all():
            return {int(v): int(values[k]) for v, k in zip(values, label)}
        label = new


@pytest.mark.parametrize("shard", [100_000, 200, 12])
def test_simhash_of_thousands_of_near_fingerprints(spark, shard, monkeypatch):
    """A cluster whose fingerprints agree in most blocks, a chain across all bits and strangers: one tree, shards, hot shards
    and shards cut into parts find the same components as comparing all."""
    r = random.Random(5)
    base = r.getrandbits(64)
    fps = {base ^ sum(1 << b for b in r.sample(range(24), r.randint(2, 6))) for _ in range(4000)}
    x = r.getrandbits(64)
    for _ in range(300):
        x ^= sum(1 << b for b in r.sample(range(64), r.randint(1, 3)))
        fps.add(x)
    fps |= {r.getrandbits(64) for _ in range(400)}
    signed = {f - (1 << 64) if f >> 63 else f: f for f in fps}
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.links(nodes, 3, shard)
    label = dict(tuple(x) for x in simhash.components(edges).collect())
    got, want = {}, {}
    for f, v in signed.items():
        got.setdefault(label.get(f, f), set()).add(v)
    for v, top in brute_components(fps).items():
        want.setdefault(top, set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert len(fps) > 3500 and len(want) < 500


def test_simhash_links_come_from_searches_of_trees(spark):
    """What deals fingerprints to shards decides little: of the pairs in a shard, the trees reject all but very few."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    nodes = simhash.fingerprints(docs).select("fp").distinct().cache()
    fps = [r.fp & (2**64 - 1) for r in nodes.collect()]
    bits = simhash.shard_bits(len(fps), simhash.SHARD, 3)
    together = 0
    for m in simhash.block_masks(3, bits):
        sizes = Counter(f & m & (2**64 - 1) for f in fps).values()
        assert max(sizes) > simhash.SHARD / 4
        together += sum(n * (n - 1) // 2 for n in sizes)
    found = simhash.links(nodes).count()
    assert 0 < found < together / 10_000
    assert simhash.shard_bits(900, simhash.SHARD, 3) == 0 and simhash.block_masks(3, 0) == [0]
    assert simhash.shard_bits(10_000, simhash.SHARD, 3) == 4 and simhash.shard_bits(10**12, simhash.SHARD, 3) == 16


def test_simhash_stage_keeps_one_row_of_each_group(spark):
    a, b = prose(21, 300), prose(22, 200)
    rows = [(None, a, "en", "s1", 1), (None, a, "en", "s1", 1), (None, a, "en", "s2", 1), (4, b, "en", "x", 2), (4, b, "en", "x", 2),
            (7, b, "en", "y", 3), (None, None, None, None, None), (None, "", None, None, None), (9, prose(23, 50), "en", None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = [(None, "", None, None, None), (None, a, "en", "s1", 1), (4, b, "en", "x", 2), (9, rows[-1][1], "en", None, 4)]
    got = [tuple(x) for x in simhash.simhash_stage(spark, df, "").collect()]
    empties = [x for x in got if not x[1]]
    assert len(empties) == 1
    assert sorted((x for x in got if x[1]), key=repr) == sorted(want[1:], key=repr)
    with_map = df.withColumn("__llm_n", F.create_map(F.lit("k"), F.col("source")))
    assert simhash.simhash_stage(spark, with_map, "").count() == len(want)
    assert simhash.simhash_stage(spark, df.limit(0), "").count() == 0


def test_block_masks_meet():
    r = random.Random(1)
    for _ in range(500):
        x = r.getrandbits(64)
        y = x ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3)))
        for bits in (1, 7, 16):
            agree = [t for t, m in enumerate(simhash.block_masks(3, bits)) if not (x ^ y) & m & (2**64 - 1)]
            assert agree
        assert any(not (x ^ y) & m & (2**64 - 1) for t in agree for m in simhash.finer_masks(3)[t])
    assert len(simhash.block_masks(3, 5)) == 4 and sorted(map(len, simhash.finer_masks(3))) == [4] * 4
    assert all(bin(m & (2**64 - 1)).count("1") == 28 for under in simhash.finer_masks(3) for m in under)


def check_packing(out, rows, window=2048):
    tokens = {}
    for d, t in rows:
        tokens.setdefault(d, []).append(brute.token_ids(t))
    by_doc, by_seq = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for d, lists in tokens.items():
        if len(lists) > 1:  # rows of one id cannot be told apart by it
            assert sum(r.length for r in by_doc[d]) == sum(map(len, lists))
            continue
        ids, at = lists[0], 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == brute.crc(ids[at:at + r.length])
            at += r.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window and at & (at - 1) == 0  # a power of two: no padding


@pytest.mark.parametrize("table", ["edge", "small"])
def test_packing(table, request):
    docs, rows = request.getfixturevalue(table)
    check_packing(packing.pack(docs).collect(), rows)


def test_packing_levels_minimise_squares():
    r = random.Random(2)
    packer = packing.SumOfSquaresPacker(32)
    for _ in range(300):
        size = r.randint(1, 31)
        counts = packer.count.copy()
        squares = {}
        for level in [0, *[h for h in range(1, 32) if counts[h] and h + size <= 32]]:
            c = counts.copy()
            c[level] -= bool(level)
            c[level + size] += level + size < 32
            squares[level] = int((c ** 2).sum())
        assert squares[packer.level_for(size)] == min(squares.values())
        packer.place((0, 0, b"\0" * 4 * size, size))


@pytest.mark.parametrize("tasks", [1, 8, 64])
def test_packing_is_by_the_levels(tasks):
    """Nine tenths of what is placed stay where the levels put it, however small the tasks are, and no id is padding."""
    r = random.Random(4)
    sizes = [min(2047, int(r.lognormvariate(6, 1)) + 1) for _ in range(10_000)]
    placed = chosen = 0
    for k in range(tasks):
        packer = packing.SumOfSquaresPacker()
        full = [packer.place((i, 0, bytes(4 * n), n)) for i, n in enumerate(sizes[k::tasks])]
        rest = list(packer.rest())
        lengths = [sum(len(p[2]) // 4 for p in items) for items in [*filter(None, full), *rest]]
        assert sum(lengths) == sum(sizes[k::tasks]) and all(n & (n - 1) == 0 for n in lengths)
        assert sum(n < 2048 for n in lengths) <= 11
        placed, chosen = placed + sum(lengths), chosen + packer.chosen
    assert chosen >= 0.9 * placed


@pytest.mark.parametrize("table", ["edge", "small"])
def test_quality_rules(table, request):
    docs, rows = request.getfixturevalue(table)
    out = quality_rules.judge(docs).collect()
    got = sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in out], key=repr)
    want = []
    for d, t in rows:
        c = brute.base_counts(t)
        want.append((d, *c, c[0] < 20 or 100 * c[4] > 30 * c[0]))
    assert got == sorted(want, key=repr)
    assert all(r.kept is not None and not (r.kept and r.base_failed) for r in out)


def test_jensen_shannon(spark):
    import math
    p, q = [3.0, 0.0, 5.0, 1.0], [1.0, 2.0, 0.0, 9.0]
    a, b = [x / sum(p) for x in p], [x / sum(q) for x in q]
    kl = lambda x, m: sum(u * math.log2(u / v) for u, v in zip(x, m) if u)
    m = [(x + y) / 2 for x, y in zip(a, b)]
    want = math.sqrt((kl(a, m) + kl(b, m)) / 2)
    df = spark.createDataFrame([(p, q, [0.0] * 4)], "p array<double>, q array<double>, z array<double>")
    r = df.select(quality_rules._distance(F.col("p"), F.col("q")), quality_rules._distance(F.col("p"), F.col("p")),
                  quality_rules._distance(F.col("p"), F.col("z"))).first()
    assert abs(r[0] - want) < 1e-12 and r[1] < 1e-7 and r[2] is None


HARD = ["a@b.c_d@e.f", "x.y+z%w@mail-1.example.com, foo@bar", "1.2.3.4.5.6.7.8 999.1.1.1 0012.0.0.1", "+1 (017) 555-7713.",
        "4111 1111-1111 1111 and 4111111111111112", "+123", "é@b.com ü1.2.3.4", "4539 5787 6362 1486 4539578763621486",
        "tel +49 (30) 1234-5678 90, +12 3", "a@b.c.d@e.f", "@@a@b..c", "12345678901234567890 55.", "ñ" * 30 + " q@w.e",
        "++1 234 567 8901+1 234 567 8902", "99999999999.1.2.3", "00000000000000000000000255.1.2.3", "𝒳 a@b.co 𝒴 1.1.1.1"]


@pytest.mark.parametrize("table", ["edge", "small", "hard"])
def test_private_base_spans(table, request, spark):
    if table == "hard":
        rows = list(enumerate(HARD))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
    else:
        docs, rows = request.getfixturevalue(table)
    out = private_terms.find_private(docs).collect()
    got = sorted([(r.doc_id, [tuple(s) for s in r.base]) for r in out], key=repr)
    assert got == sorted([(d, brute.personal(t)) for d, t in rows], key=repr)
    assert all(set(map(tuple, r.base)) <= set(map(tuple, r.spans)) for r in out)


def test_private_long_runs_end(spark):
    rows = [(1, "a" * 300_000), (2, "1 " * 100_000), (3, "+1" + "(" * 200_000), (4, "a@" + "b." * 100_000), (5, "1." * 8_000)]
    out = {r.doc_id: r.base for r in private_terms.find_private(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [len(out[k]) for k in (1, 2, 3, 4)] == [0, 0, 0, 1] and len(out[5]) == 2_000


def test_private_terms_by_information(spark):
    """A word that only occurs beside one address, in different contexts, reveals it; a frequent one does not."""
    rows = [(k, f"{prose(100 + k, 6)} Zorbulax the owner kim@mail.example.com {prose(200 + k, 6)}") for k in range(4)]
    rows += [(10 + k, f"{prose(300 + k, 30)} owner of the house") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in private_terms.find_private(docs).collect()}
    texts = dict(rows)
    for k in range(4):
        terms = [texts[k][s["start"]:s["end"]] for s in out[k].spans if s["rank"] == 4]
        assert "Zorbulax" in terms and "owner" not in terms and "the" not in terms
    assert all(not out[k].spans for k in range(10, 50))
    r = docs.where("doc_id = 0").join(private_terms.find_private(docs), "doc_id") \
        .select(private_terms.redact(F.col("text"), F.col("spans"))).first()[0]
    assert "[EMAIL]" in r and "[TERM]" in r and "kim@" not in r and "Zorbulax" not in r


def private_corpus(seed):
    """Documents of few words with addresses in several spellings, exact and near copies, repeated rows and null ids."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["Zorbulax", "(Qonto)", "éclair", "x1", "..."]
    people = ["kim@Mail.example.com", "KIM@mail.EXAMPLE.com", "10.0.0.7", "+49 30 1234567", "+4930-1234-567", "bo@x.org",
              "4111 1111 1111 1111", "4111-1111-1111-1111"]
    rows = []
    for k in range(90):
        words = [r.choice(vocabulary) for _ in range(r.randint(3, 40))]
        if r.random() < 0.4:
            who = r.choice(people)
            words.insert(r.randrange(len(words)), who)
            if "im@" in who or "IM@" in who:
                words.insert(r.randrange(len(words)), "Zorbulax,")
        rows.append((k if k % 13 else None, " ".join(words)))
    family = prose(77, 40).split()
    for k in range(12):
        family[r.randrange(40)] = "edit"
        rows.append((200 + k, " ".join([*family, "fam@copy.net"])))
    return rows + rows[:6] + [(500, None), (501, ""), (502, rows[3][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_private_terms_against_brute_force(spark, seed):
    rows = private_corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({
        c: F.lit(None).cast("string") for c in ("entity", "term", "doc", "t_doc", "spans", "n_e", "words")}).repartition(4)
    terms = brute.private_terms(rows, 3, 0.5)
    want = sorted(((d, sorted([*map(tuple, brute.personal(t)), *terms.get((d, t or ""), ())])) for d, t in rows), key=repr)
    got = sorted([(r.doc_id, [tuple(s) for s in r.spans]) for r in private_terms.find_private(docs, 3, 0.5).collect()], key=repr)
    assert got == want
    assert any(s[1] == 4 for _, spans in got for s in spans)


def test_private_terms_ignore_the_words_of_copies(spark):
    rows = [(k, f"{prose(31, 60)} me@one.net") for k in range(40)]  # exact copies
    rows += [(100 + k, " ".join([*prose(32, 30).split(), f"v{k}", *prose(33, 30).split(), "you@two.net"])) for k in range(40)]  # near copies
    rows += [(300 + k, prose(400 + k, 40)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(s.rank < 4 for r in private_terms.find_private(docs).collect() for s in r.spans)


def test_items_that_are_not_searched_are_listed(spark):
    items = spark.createDataFrame([(1, "x" * 24), (2, None), (3, " a  b "), (4, "y " * 12), (5, "z" * 23)], "item_id long, text string")
    assert sorted(r.item_id for r in decontamination.unsearched(items).collect()) == [2, 3, 4, 5]


def test_decontamination(spark):
    r = random.Random(8)
    items = [(k, prose(500 + k, 25)) for k in range(6)] + [(7, None), (8, "tiny"), (9, "")]
    rows, want = [], set()
    for d in range(30):
        text = prose(900 + d, 60)
        if d % 3 == 0:
            k = d % 6
            item = decontamination.normalise(items[k][1])
            edits = int(len(item) * decontamination.ERROR_RATE) if d % 2 else 0
            chars = list(item)
            for p in r.sample(range(len(chars)), edits // 2):
                chars[p] = "#"
            text = text[:100] + " " + "".join(chars).upper() + "\n" + text[100:]
            want.add((d, k))
        rows.append((d, text))
    rows += [(None, items[1][1]), (40, None), (41, "")]
    want.add((None, 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("distance", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (decontamination.BLOCK_CHARS, 200):
        out = decontamination.find_passages(docs, bench, block_chars=block).collect()
        assert {(x.doc_id, x.item_id) for x in out} == want
    texts, names = dict(rows), dict(items)
    for x in out:
        whole = decontamination.normalise(texts[x.doc_id])
        item = decontamination.normalise(names[x.item_id])
        assert brute.best_distance(item, whole) == x.distance == brute.best_distance(item, whole[x.start:x.end])
    left = decontamination.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert {x.doc_id for x in left.collect()} == {d for d, _ in rows} - {d for d, _ in want}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find_passages(docs, none).count() == 0
    assert decontamination.drop_contaminated(docs, none).count() == len(rows)


def test_decontamination_finds_every_passage_within_budget():
    """Against plain dynamic programming over random edits."""
    r = random.Random(12)
    item = decontamination.normalise(prose(77, 30))
    matcher = decontamination.Matcher([(1, item)], decontamination.ERROR_RATE)
    k = int(len(item) * decontamination.ERROR_RATE)
    for trial in range(60):
        chars = list(item)
        for _ in range(r.randint(0, k + 3)):
            p, kind = r.randrange(len(chars)), r.randrange(3)
            if kind == 0:
                chars[p] = r.choice("abcde")
            elif kind == 1:
                chars.insert(p, r.choice("abcde"))
            else:
                del chars[p]
        text = prose(trial, 20) + "".join(chars) + prose(trial + 500, 20)
        want = brute.best_distance(item, text)
        got = list(matcher.matches(text))
        assert [g[1] for g in got] == ([want] if want <= k else [])


def test_line_dedup_edges(edge):
    docs, _ = edge
    out = {(r.doc_id, r.text): r["__llm_lines"] for r in line_dedup.dedup_lines(docs).collect()}
    texts = {d: t for d, t in edge_rows() if d is not None}
    assert out[(12, texts[12])].n_removed == 0
    assert out[(13, texts[13])].n_removed == 8 and out[(13, texts[13])].n_spans == 1
    assert out[(14, texts[14])].n_removed == 16 and out[(14, texts[14])].text == ""
    assert out[(17, texts[17])].n_removed == 0 and out[(4, None)].n_lines == 0
    staged = line_dedup.line_stage(docs.sparkSession, docs, SF)
    assert staged.columns == docs.columns and staged.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    assert staged.where("n_chars is distinct from length(text)").count() == 0


@pytest.mark.parametrize("module, label, train", [(quality_classifier, "quality", quality_classifier.train),
                                                  (toxicity, "toxic", toxicity.train)])
def test_classifiers_on_edges(module, label, train, edge, empty, small, labels, spark):
    docs, rows = edge
    model = train(small[0], labels)
    out = module.score_documents(docs, model).select("doc_id", "score").collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert module.score_documents(empty, model).count() == 0
    none = spark.createDataFrame([], labels.schema)
    odd = spark.createDataFrame([(3, None, None), (None, 1, 1), (5, 1, 1), (5, 0, 0), (99, 1, 1)], labels.schema)
    for few in (none, odd):
        scores = {r.score for r in module.score_documents(docs, train(docs, few)).select("score").collect()}
        assert len(scores) == 1 and 0 <= scores.pop() <= 1


def test_labels_of_the_held_out_fold_are_not_read(small, labels):
    docs, _ = small
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    for train, folds, held in ((quality_classifier.train, 5, 0), (toxicity.train, 4, 2)):
        turned = labels.withColumns({c: F.when(fold % folds == held, 1 - F.col(c)).otherwise(F.col(c)).cast("int")
                                     for c in ("quality", "toxic")})
        assert train(docs, labels) == train(docs, turned)


def test_rule_column_equals_matrix(spark):
    import numpy as np
    r = np.random.default_rng(0)
    x = r.random((300, len(quality_classifier.STATISTICS)))
    y = ((x[:, 0] > 0.6) & (x[:, 3] < 0.7)).astype(float)
    model = quality_classifier.fit_rules(x, y)
    assert model.rules and ((model.predict(x) > 0.5) == y).mean() > 0.97
    df = spark.createDataFrame([tuple(map(float, v)) for v in x], list(quality_classifier.STATISTICS))
    got = df.select(model.column(F.struct(*quality_classifier.STATISTICS)).alias("s")).toPandas()["s"].to_numpy()
    assert np.allclose(np.sort(got), np.sort(model.predict(x)))


def test_toxicity_folding_and_exceptions():
    fold = toxicity.fold
    assert fold("Ｉd1ot!") == fold("idiot") and fold("іdiοt") == fold("idiot") and fold("wörthless###") == fold("worthless")
    model = toxicity.ToxicityModel({"idiot": 2.0}, ("idiot proof",), (-1.0, 1.0, 0.0))
    f = model.features(["an idi0t", "it is Idiot-proof", "idiots", "", "idiot proof idiot"], model.automaton())
    assert [bool(v) for v in f[:, 0]] == [True, False, False, False, True]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_with_sql(name, spark):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    cols = sorted(c[0] for c in want.description)
    names = [c[0] for c in want.description]
    want = sorted([tuple(dict(zip(names, r))[c] for c in cols) for r in want.fetchall()], key=repr)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == cols
    assert rows_of(got.select(*cols)) == want


def test_every_query_runs_on_empty_tables(spark, empty, labels, workdir):
    root = f"{workdir}/empty"
    empty.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([], labels.schema).write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{root}/conversations.parquet")
    for name, query in QUERIES.items():
        assert query(spark, root).count() == 0, name


def test_nothing_else_imports_this_package():
    """The library and its other queries work where the package is not there."""
    code = ("import sys, json; sys.modules['streamload.llm'] = None\n"
            "import importlib.util, __spark_entry__ as e; print(json.dumps(sorted(e.queries())))")
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], cwd=repo, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert not any(n.startswith("op") for n in json.loads(out.stdout)) and "pipeline" not in json.loads(out.stdout)
