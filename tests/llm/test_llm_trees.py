"""Operators 11 to 13 against plain versions: tables of edge cases, small parameters, and the small tables."""

import hashlib
import html
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from streamload.llm import html_extraction, merkle, places, prefix_trie
from streamload.llm.html_extraction import main_text

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=repr)


# --------------------------------------------------------------------------- operator 11

SIDE = "<div class='sidebar'><p>Side text, more, and longer, than, many others, in here, to score, lots of points.</p></div>"
LONG = "<p>" + "A sentence, with commas, that goes on for a while. " * 4 + "</p>"
LONG_TEXT = ("A sentence, with commas, that goes on for a while. " * 4).strip()

PAGES = [
    (None, ""), ("", ""), (" \n", ""), ("plain text", "plain text"), ("<p>", ""), ("a < b &amp; c &lt; d &#233; &unknown; &am",
                                                                              "a < b & c < d é &unknown; &am"),
    ("<article><h1>T</h1><p><b>x<br><p>y\n\t z&nbsp;w</p></article>", "T\nx\ny z w"),
    ("<nav><a href=1>m</a></nav><article><p>Short.</p></article><div class=ad>" + LONG_TEXT + "</div>", "Short."),
    ("<header><h1>Site</h1></header><main><h2>A</h2><p>x</p><section><p>" + LONG_TEXT + "</p></section></main><footer>f</footer>",
     "A\nx\n" + LONG_TEXT),
    ("<article><header><h1>Head</h1></header>" + LONG + "<aside>no</aside><form><p>Mail</p><input></form><section id=comments>"
     + LONG * 3 + "</section><footer>f</footer></article>", "Head\n" + LONG_TEXT),
    ("<body class='has-sidebar'><div id=wrap class='with-sidebar'><h1>Title</h1><div class='post-body'>" + LONG * 3
     + "<ul><li>one<li>two</ul></div>" + SIDE + "<div class=commentlist>" + LONG * 9 + "</div></div>",
     "\n".join(["Title", *[LONG_TEXT] * 3, "one", "two"])),
    ("<form id=page><table><tr><td><a href=1>menu</a><td>" + LONG * 3 + "</table></form>", "\n".join([LONG_TEXT] * 3)),
    ("<div id=a><p>" + "word " * 30 + "</p></div><script>document.write('<p>no</p>')</script><style>p{}</style><!-- <p>no</p> -->",
     ("word " * 30).strip()),
    ("<article><p>see <a href=1>this</a>, and more</p><ul><li><a href=1>r1</a><li><a href=2>r2</a><li><a href=3>r3</a></ul>" + LONG + "</article>",
     "see this, and more\n" + LONG_TEXT),
    ("<div hidden><p>" + LONG_TEXT + "</p></div><article><p>seen</p><p style='display: none'>not</p></article>", "seen"),
    ("<article><blockquote>q</blockquote><pre>a\n  b</pre><table><tr><td>1<td>2</table><p>unfinished <a href=", "q\na b\n1\n2\nunfinished"),
    ("<script>never closed <p>x</p>", ""),
    ("<article><p>kept</p><ins class=adsbygoogle>ad</ins><fieldset><label>Name</label></fieldset><label>Vote</label></article>", "kept"),
    ("<div class='page'><div class='header-top'>brand</div><p>" + "Some words, and more. " * 6 + "</p><p>" + "Other words, as well. " * 6
     + "</p><div class='related-posts'><p>" + "You may also like this, and that. " * 9 + "</p></div></div><div id=footer>(c)</div>",
     ("Some words, and more. " * 6).strip() + "\n" + ("Other words, as well. " * 6).strip()),
    ("<div class=footer><p>only this</p></div>", "only this"),
]


@pytest.mark.parametrize("k", range(len(PAGES)))
def test_main_text(k):
    assert main_text(PAGES[k][0]) == PAGES[k][1]


def test_main_text_takes_pages_of_any_size_and_nesting():
    assert main_text("<div>" * 30_000 + "x") == "x"
    assert main_text("<article>" + "<p>wo rd" * 50_000).count("\n") == 49_999
    assert main_text("<" * 100_000) == "<" * 100_000
    assert len(main_text("<p>" + "word, " * 300_000)) == 1_799_999


def test_extract_keeps_rows_and_columns(spark):
    rows = [(k, "u", page, "mine", 1) for k, (page, _) in enumerate(PAGES)] + [(None, None, PAGES[6][0], None, 2)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    out = html_extraction.extract_articles(df)
    assert out.columns == [*df.columns, "__llm_article"]
    got = sorted((repr(r.page_id), r.text, r.n_chars, r["__llm_article"].text, r["__llm_article"].n_chars) for r in out.collect())
    want = [(repr(k), "mine", 1, text, len(text)) for k, (_, text) in enumerate(PAGES)] + [("None", None, 2, PAGES[6][1], len(PAGES[6][1]))] * 2
    assert got == sorted(want, key=lambda x: x[:1] + x[3:])  or sorted(map(repr, got)) == sorted(map(repr, want))
    assert html_extraction.extract_articles(df.limit(0)).count() == 0


def test_op11_on_the_small_table(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in html_extraction.op11_html_extraction(spark, SF).collect():
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner.replace("<br>", " ")))
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)


# --------------------------------------------------------------------------- places

def test_places_of_hot_groups_ties_and_repeated_rows(spark):
    r = random.Random(1)
    rows = [("hot", None if r.random() < .1 else r.randrange(40)) for _ in range(600)] + [(f"g{r.randrange(9)}", r.randrange(5)) for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(7)
    got = defaultdict(list)
    for x in places.with_places(df, "g", ["v"], "place", "test-places").collect():
        got[x.g].append((x.place, x.v))
    assert sum(map(len, got.values())) == len(rows)
    for g, found in got.items():
        found.sort()
        assert [p for p, _ in found] == list(range(len(found)))
        want = sorted((v for k, v in rows if k == g), key=lambda v: (v is not None, v))
        assert [v for _, v in found] == want


# --------------------------------------------------------------------------- operator 12

def test_missing_is_the_minimal_union():
    for n in range(1, 20):
        for low in range(n):
            for high in range(low + 1, n + 1):
                need, have, size = set(), set(), n
                for level in range(merkle.depth(n)):
                    nodes = {p >> level for p in range(low, high)}
                    have |= {(level, p) for p in nodes}
                    need |= {(level, p ^ 1) for p in nodes if p ^ 1 < size}
                    size = (size + 1) // 2
                assert set(merkle.missing(n, low, high)) == need - have


def plain_tree(leaves):
    """root, and for each leaf the siblings from the bottom up with the side on which they stand."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([sha("".join(row[k:k + 2])) for k in range(0, len(row), 2)])
    paths = []
    for p in range(len(leaves)):
        path = []
        for row in levels[:-1]:
            path.append((p & 1, row[p ^ 1] if p ^ 1 < len(row) else ""))
            p >>= 1
        paths.append(path)
    return levels[-1][0], paths


def plain_manifest(rows, tamper):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text)."""
    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    subs = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs[lang] = plain_tree([leaf(r) for r in groups[lang]])
    root, tops = plain_tree([subs[x][0] for x in langs])
    out = []
    for lang, top in zip(langs, tops):
        for row, path in zip(groups[lang], subs[lang][1]):
            node = leaf(row) if not tamper(row) else leaf((*row[:3], row[3] + 1, row[4]))
            for right, other in [*path, *top]:
                node = sha(other + node if right else node + other)
            out.append((row[0], leaf(row), subs[lang][0], root, sha("".join(x for _, x in [*path, *top])), node, node == root))
    return sorted(out, key=repr)


def edge_documents(n=90, langs=("en", "de", None, "", "zz", "é")):
    r = random.Random(3)
    rows = [(k * 3, r.choice(["s", None]), r.choice(langs), r.choice([None, 5, 7]), r.choice(["x y", "", None, "é" * 50])) for k in range(n)]
    rows += [rows[4]] * 3 + [(None, None, None, None, None)] * 3 + [(None, "s", "en", 1, "t"), (12, "s", "en", 2, "a"), (12, "s", "en", 2, "b"), (2**60, "s", "en", 2**63 - 1, "z" * 100_000)]
    return rows + [(1000 + k, "one", "lone", 3, "q") for k in range(1)] + [(5000 + k, "h", "hot", 3, f"q{k}") for k in range(67)]


@pytest.mark.parametrize("levels", [1, 3, 10])
def test_op12_against_a_plain_version(spark, monkeypatch, tmp_path, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows = edge_documents()
    extra = "n long, place long, tree string, node string, id int, root string, run int, __group string"
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string") \
        .withColumns({c.split()[0]: F.lit(None).cast(c.split()[1]) for c in extra.split(", ")}).repartition(5)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = rows_of(merkle.op12_merkle_manifest(spark, str(tmp_path)),
                  "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    want = plain_manifest(rows, lambda r: r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0)
    assert got == want
    assert any(not x[-1] for x in got)


def test_op12_with_many_groups_joins_instead_of_broadcasting(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "MAX_BROADCAST", 3)
    rows = edge_documents(60, tuple(f"l{k}" for k in range(23)))
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = rows_of(merkle.op12_merkle_manifest(spark, str(tmp_path)),
                  "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert got == plain_manifest(rows, lambda r: r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0)


def test_op12_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert merkle.op12_merkle_manifest(spark, str(tmp_path)).count() == 0


# --------------------------------------------------------------------------- operator 13

def plain_trie(rows):
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            talks[c].append((turn, role or "", text or ""))
    for c in talks:
        talks[c].sort(key=lambda t: (t[0] is not None, t[0] or 0, sha(f"{len(t[1].encode())}:{t[1]}{t[2]}")))
    rebuilt = {}
    for c, turns in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c > 0 else -1)
        rebuilt[c] = tuple(t[1:] for t in talks.get(base, [])[:h]) + tuple(t[1:] for t in turns[h:])
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    out = []
    for seq, cs in members.items():
        under = [x for x in members if x[:len(seq)] == seq]
        kids = [x for x in under if len(x) == len(seq) + 1]
        leaves = [x for x in under if not any(y[:len(x)] == x and len(y) == len(x) + 1 for y in under)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in under if x)
        ends = sorted(c for c in cs if len(rebuilt[c]) == len(seq))
        out.append((min(cs), len(seq), min(members[seq[:-1]]) if seq else None, len(cs), len(kids), len(leaves), saved,
                    sha(",".join(map(str, ends)))))
    return sorted(out, key=repr)


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def edge_talks():
    r = random.Random(5)
    rows = []
    for c in [*range(-12, 30), 101, 102, 2**61]:
        rows += [(c, k, r.choice(["user", None]), r.choice(["hi", "yo", "", None, "é"])) for k in range(r.randrange(1, 7))]
    rows += [(c, k, "user", "same") for c in range(200, 260) for k in range(4)]  # copies
    rows += [(300, k, "u", f"t{k % 3}") for k in range(40)] + [(301, 0, "u", "w" * 60_000)]
    rows += [(7, 3, "user", "hi")] * 3 + [(8, None, "user", "first"), (8, None, None, None), (None, 0, "user", "lost"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("limits", [None, (5, 2, 2, 3, 0), (30, 4, 4, 1, 100)])
def test_op13_against_a_plain_version(spark, monkeypatch, tmp_path, limits):
    if limits:
        for name, value in zip(("SHARD_ROWS", "QUEUE", "CHUNK", "PIECE", "MAX_BROADCAST"), limits):
            monkeypatch.setattr(prefix_trie, name, value)
    rows = edge_talks()
    extra = "n long, h int, k1 string, depth int, bytes string, pos int, base long, s1 int, __group int"
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .withColumns({c.split()[0]: F.lit(None).cast(c.split()[1]) for c in extra.split(", ")}).repartition(5) \
        .write.parquet(str(tmp_path / "conversations.parquet"))
    assert rows_of(prefix_trie.op13_prefix_trie(spark, str(tmp_path)), *TRIE) == plain_trie(rows)


def test_op13_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert prefix_trie.op13_prefix_trie(spark, str(tmp_path)).count() == 0


def test_the_queue_gives_back_in_order_what_it_spilled():
    r = random.Random(2)
    queue, want = prefix_trie.SpillingQueue(7), defaultdict(list)
    for k in range(500):
        place = (r.randrange(9), r.randrange(9))
        queue.push((place, k))
        want[place].append(k)
    assert len(queue.runs) > 10 and len(queue.memory) <= 8
    for place in sorted(want):
        assert sorted(k for _, k in queue.take(place)) == want[place]
    assert not queue
