import pytest

from streamload import FieldMapping
from streamload.operators import flatten, parse_json_records, parse_messages, project_envelope
from streamload.functions import schema_from_mappings

MAP = [FieldMapping("event_id", "event_id"), FieldMapping("id", "c.id"), FieldMapping("amt", "c.amt", "int"),
       FieldMapping("d", "d", "date")]

# (case, text, failed, event_id, id, amt, d)  — FIXTURES.md §5, column "ours"
FAULTS = [
    ("ok", '{"event_id":"E1","c":{"id":"x","amt":5},"d":"2026-01-02"}', False, "E1", "x", 5, "2026-01-02"),
    ("cut top", '{"event_id":"E2",', True, None, None, None, None),
    ("cut nested string", '{"event_id":"E21","d":"2026-01-02","c":{"id":"x","am', True, None, None, None, None),
    ("cut after nested key", '{"event_id":"E1","c":{"id"', True, None, None, None, None),
    ("plain text", "hello", True, None, None, None, None),
    ("empty", "", True, None, None, None, None),
    ("blank", "   ", True, None, None, None, None),
    ("sql null", None, True, None, None, None, None),
    ("json null", "null", True, None, None, None, None),
    ("array", '[{"event_id":"E3"}]', True, None, None, None, None),
    ("scalar", "5", True, None, None, None, None),
    ("wrong leaf type", '{"event_id":"E5","c":{"id":7,"amt":"oops"}}', False, "E5", "7", None, None),
    ("int overflow", '{"event_id":"E6","c":{"id":"q","amt":3000000000}}', False, "E6", "q", None, None),
    ("fraction into int", '{"event_id":"E7","c":{"id":"s","amt":3.7}}', False, "E7", "s", None, None),
    ("bad date", '{"event_id":"E10","d":"nope"}', False, "E10", None, None, None),
    ("scalar for object", '{"event_id":"E8","c":"str"}', False, "E8", None, None, None),
    ("only field mistyped", '{"c":"str"}', False, None, None, None, None),
    ("object into string", '{"event_id":{"a":1},"c":{"id":[1,2],"amt":3}}', False, '{"a":1}', "[1,2]", 3, None),
    ("no mapped field", '{"x":1}', False, None, None, None, None),
    ("empty object", "{}", False, None, None, None, None),
    ("json null key", '{"event_id":null,"c":{"id":"z"}}', False, None, "z", None, None),
    ("duplicate key", '{"event_id":"E12","event_id":"E13"}', False, "E13", None, None, None),
    ("single quotes", "{'event_id':'E14'}", False, "E14", None, None, None),
    ("text after object", '{"event_id":"E9"} junk', True, None, None, None, None),
    ("second object", '{"event_id":"E9"}{"event_id":"E10"}', True, None, None, None, None),
    ("bracket after object", '{"event_id":"E9"}]', True, None, None, None, None),
    ("list of objects", '{"event_id":"E9"},{"event_id":"E10"}', True, None, None, None, None),
    ("key case", '{"EVENT_ID":"E11"}', False, None, None, None, None),
]


@pytest.fixture(scope="module")
def parsed_faults(spark):
    df = spark.createDataFrame([(c, t) for c, t, *_ in FAULTS], "case string, json_raw string")
    out = parse_json_records(df, schema_from_mappings(MAP))
    rows = flatten(out, MAP, keep=["case", "parse_failed"]).collect()
    return {r["case"]: r for r in rows}


@pytest.mark.parametrize("case,text,failed,eid,cid,amt,d", FAULTS, ids=[f[0] for f in FAULTS])
def test_fault_table(parsed_faults, case, text, failed, eid, cid, amt, d):
    r = parsed_faults[case]
    assert r["parse_failed"] is failed
    if not failed:
        assert (r["event_id"], r["id"], r["amt"]) == (eid, cid, amt)
        assert (None if r["d"] is None else r["d"].isoformat()) == d


def test_every_prefix_of_a_document_fails_and_the_whole_passes(spark):
    doc = '{"event_id":"E1","c":{"id":"x","amt":5},"d":"2026-01-02"}'
    rows = [(i, doc[:i]) for i in range(1, len(doc) + 1)]
    df = spark.createDataFrame(rows, "n int, json_raw string")
    got = {r["n"]: r["parse_failed"] for r in parse_json_records(df, schema_from_mappings(MAP)).collect()}
    assert all(got[i] for i in range(1, len(doc))) and got[len(doc)] is False


@pytest.mark.parametrize("doc", ['{"c":{"amt":"oops","id":[1,{"a":"]"}]},"event_id":"E1"}', '{"d":"nope","event_id":"}]"}', " {} "])
def test_every_cut_of_a_mistyped_document_fails_and_so_does_more_text(spark, doc):
    ends = ["", "]", "}", ",", ",{}", "{}", "]]", '"', ',"x":1', ',{"_end":1}]', "\n", " "]
    rows = [(doc[:i], True) for i in range(len(doc)) if doc[:i].strip() != doc.strip()]
    rows += [(doc + e, bool(e.strip())) for e in ends] + [(doc + "," + doc, True), ("[" + doc + "]", True), ("," + doc, True)]
    df = spark.createDataFrame(rows, "json_raw string, want boolean")
    got = parse_json_records(df, schema_from_mappings(MAP)).filter("parse_failed != want").collect()
    assert got == []


def test_lenient_mode_is_the_reference_rule(spark):
    df = spark.createDataFrame([("hello",), ("",)], "json_raw string")
    got = [r["parse_failed"] for r in parse_json_records(df, schema_from_mappings(MAP), strict=False).collect()]
    assert got == [False, True]


def test_envelope_projection_types(spark):
    df = spark.createDataFrame([(b"k", b'{"a":1}', "t", 3, 7, None, 0)],
                               "key binary, value binary, topic string, partition int, offset long, "
                               "timestamp timestamp, timestampType int")
    env = project_envelope(df)
    assert env.columns == ["json_raw", "topic", "kafka_partition", "kafka_offset", "kafka_timestamp"]
    assert [f.dataType.simpleString() for f in env.schema.fields] == ["string", "string", "int", "bigint", "timestamp"]
    assert env.first()["json_raw"] == '{"a":1}'


def test_odd_names_and_single_select(spark):
    ms = [FieldMapping("parsed", "a.b"), FieldMapping("x.y", "we-ird"), FieldMapping("n", "a.c", "long")]
    df = spark.createDataFrame([(b'{"a":{"b":"v","c":5},"we-ird":"w"}', "t", 0, 1, None)],
                               "value binary, topic string, partition int, offset long, timestamp timestamp")
    p = parse_messages(df, ms)
    out = flatten(p, ms).first()
    assert (out["parsed"], out["x.y"], out["n"]) == ("v", "w", 5)


def test_column_pruning_keeps_only_mapped_paths(spark):
    ms = [FieldMapping("id", "event_id")]
    schema = schema_from_mappings(ms)
    assert schema.fieldNames() == ["event_id"]
    df = spark.createDataFrame([('{"event_id":"1","big":{"x":[1,2,3]}}',)], "json_raw string")
    assert flatten(parse_json_records(df, schema), ms).columns == ["id"]


# Cases where the text is one complete object but a mapped leaf has the wrong JSON type.
MISTYPED = {"wrong leaf type", "int overflow", "fraction into int", "bad date", "scalar for object",
            "only field mistyped"}


@pytest.mark.parametrize("case,text,failed", [f[:3] for f in FAULTS], ids=[f[0] for f in FAULTS])
def test_type_mismatch_as_error(spark, case, text, failed):
    df = spark.createDataFrame([(text,)], "json_raw string")
    got = parse_json_records(df, schema_from_mappings(MAP), on_type_mismatch="error").first()["parse_failed"]
    assert got is (failed or case in MISTYPED)


def test_type_mismatch_rejects_unknown_mode(spark):
    df = spark.createDataFrame([("{}",)], "json_raw string")
    with pytest.raises(ValueError):
        parse_json_records(df, schema_from_mappings(MAP), on_type_mismatch="maybe")


# (case, text, failed) in VARIANT mode: like the strict rule, except that
# duplicate keys and single quotes are not JSON for try_parse_json.
VARIANT_FAILS = {c for c, t, failed, *_ in FAULTS if failed} | {"duplicate key", "single quotes"}


@pytest.mark.parametrize("case,text", [f[:2] for f in FAULTS], ids=[f[0] for f in FAULTS])
def test_variant_parse_failure_rule(spark, case, text):
    from streamload.operators.parse import parse_variant_records
    df = spark.createDataFrame([(text,)], "json_raw string")
    assert parse_variant_records(df).first()["parse_failed"] is (case in VARIANT_FAILS)


def test_variant_flattener_reads_any_path(spark):
    from streamload.operators.hooks import document_field
    from streamload.operators.parse import parse_variant_records
    from streamload.functions.columns import variant_path
    assert variant_path("a.we-ird") == "$.a['we-ird']" and variant_path("a_1.b") == "$.a_1.b"
    df = spark.createDataFrame([('{"a":{"b":"7","we-ird":"w","n":"x"}}',)], "json_raw string")
    p = parse_variant_records(df)
    r = p.select(document_field(p, "a.b", "int").alias("b"), document_field(p, "a.we-ird", "string").alias("w"),
                 document_field(p, "a.n", "int").alias("n")).first()
    assert (r["b"], r["w"], r["n"]) == (7, "w", None)
