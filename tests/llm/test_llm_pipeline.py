"""The corpus pipeline, stage by stage, against plain versions over what each stage was given."""

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from streamload.llm import decontamination, packing
from streamload.llm.common import materialize

SF = "/root/testdata/sf0.001"


def lines_brute(rows, window=3):
    """Texts without the later occurrences of their three-line windows."""
    first = {}
    split = {d: (t.split("\n") if t else []) for d, t in rows}
    for d in sorted(split):
        for i in range(len(split[d]) - window + 1):
            w = tuple(split[d][i:i + window])
            if any(brute.words(x) for x in w):
                first.setdefault(w, (d, i))
    out = {}
    for d, lines in split.items():
        gone = set()
        for i in range(len(lines) - window + 1):
            w = tuple(lines[i:i + window])
            if w in first and first[w] != (d, i):
                gone.update(range(i, i + window))
        out[d] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        out.append((name, before, docs))
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_names_and_columns(stages):
    assert [n for n, _, _ in stages] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination",
                                         "packing"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns


def test_quality_keeps_clean_documents(stages, spark):
    _, before, after = stages[0]
    kept = {d for d, _ in texts(after)}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [d for d, _ in texts(before) if labels.get(d) == 1]
    assert sum(d in kept for d in good) >= 0.97 * len(good)


def test_line_stage(stages):
    _, before, after = stages[1]
    assert dict(texts(after)) == lines_brute(texts(before))


def test_simhash_stage(stages):
    _, before, after = stages[2]
    rows = texts(before)
    keep = {d for d, _, c in brute.near_duplicates(rows) if d == c}
    assert sorted(texts(after)) == sorted((d, t) for d, t in rows if d in keep)


def test_decontamination_stage(stages, spark):
    _, before, after = stages[3]
    items = [decontamination.normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = dict(texts(after))
    for d, t in texts(before):
        exact = any(i in decontamination.normalise(t) for i in items)
        assert not (exact and d in left)
    dropped = [t for d, t in texts(before) if d not in left]
    for t in dropped:
        whole = decontamination.normalise(t)
        assert any(brute.best_distance(i, whole) <= int(len(i) * decontamination.ERROR_RATE) for i in items)


def test_packing_stage(stages):
    from test_llm_operators import check_packing
    _, before, after = stages[4]
    check_packing(after.collect(), texts(before))
    assert set(packing.COLUMNS) <= set(after.columns)


def test_run_equals_its_stages(stages, spark):
    out = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    total = F.sum("length")
    assert out.agg(total).first() == stages[-1][2].agg(total).first()
    assert {tuple(r) for r in out.select("doc_id", "doc_tokens").collect()} == \
        {tuple(r) for r in stages[-1][2].select("doc_id", "doc_tokens").collect()}
    assert set(key) <= set(out.columns)


def test_stages_on_edges(spark):
    """Nulls, empty and repeated rows, and extra columns of clashing names pass every stage."""
    rows = [(1, None), (2, ""), (3, "one two three"), (3, "one two three"), (None, "four " * 40), (None, None), (4, "x" * 70_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.length("text").cast("long"),
         "score": F.lit("mine"), "fp": F.lit(1), "key": F.lit(2), "starts": F.lit(3)})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
        assert name == "packing" or out.count() <= len(rows)
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_packing_is_the_same_when_a_task_is_run_again(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = (sorted(map(tuple, packing.pack(docs).collect()), key=repr) for _ in range(2))
    assert a == b
