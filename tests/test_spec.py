import pytest
from pyspark.sql import types as T

from streamload import FieldMapping, FilterRule, PipelineSpec, SpecError, Target, mappings_from_groups
from streamload.functions import resolve_type, schema_from_mappings
from streamload.spec import check_mappings, mappings_from_fields


def test_groups_expand_with_renames_blanks_and_overrides():
    ms = mappings_from_groups(
        [{"path": "", "columns": "event_id, event_timestamp"},
         {"path": "loan_account", "columns": "account_id, loan_amount:amount, ,"}],
        [{"name": "amount", "type": "integer"}])
    assert ms == [FieldMapping("event_id", "event_id"), FieldMapping("event_timestamp", "event_timestamp"),
                  FieldMapping("account_id", "loan_account.account_id"),
                  FieldMapping("amount", "loan_account.loan_amount", "integer")]


def test_fields_shape_equals_groups_shape():
    a = mappings_from_fields([{"name": "city", "path": "customer.address.city", "type": "string"}])
    b = mappings_from_groups([{"path": "customer.address", "columns": "city"}])
    assert a == b


@pytest.mark.parametrize("ms", [
    [FieldMapping("a", "x"), FieldMapping("a", "y")],                  # same target twice
    [FieldMapping("a", "c"), FieldMapping("b", "c.d")],                # leaf and nested
    [FieldMapping("audit_load_date", "x")],                            # partition column
    [FieldMapping("a", "x..y")],                                       # empty segment
])
def test_bad_mappings_rejected(ms):
    with pytest.raises(SpecError):
        check_mappings(ms, "audit_load_date")


def test_schema_nests_paths_in_first_appearance_order():
    s = schema_from_mappings([FieldMapping("id", "event_id"), FieldMapping("cid", "customer.customer_id"),
                              FieldMapping("amt", "loan.amount", "int"), FieldMapping("city", "customer.addr.city")])
    assert s.simpleString() == ("struct<event_id:string,customer:struct<customer_id:string,addr:struct<city:string>>,"
                                "loan:struct<amount:int>>")


@pytest.mark.parametrize("name,expected", [
    ("string", T.StringType()), ("INTEGER", T.IntegerType()), ("int", T.IntegerType()), ("Long", T.LongType()),
    ("double", T.DoubleType()), ("float", T.FloatType()), ("boolean", T.BooleanType()), ("date", T.DateType()),
    ("timestamp", T.TimestampType()), ("decimal(12,2)", T.DecimalType(12, 2)),
    ("array<string>", T.ArrayType(T.StringType())),
])
def test_resolve_type(spark, name, expected):
    # DDL type strings are parsed by Spark, so a session must be active.
    assert resolve_type(name) == expected


def test_unknown_type_raises_or_falls_back(spark):
    with pytest.raises(SpecError):
        resolve_type("no_such_type")
    assert resolve_type("no_such_type", on_unknown="string") == T.StringType()


def test_spec_validation():
    ms = [FieldMapping("id", "id")]
    with pytest.raises(SpecError):
        PipelineSpec(mappings=ms, primary_keys=["missing"], target=Target(path="/x"))
    with pytest.raises(SpecError):
        PipelineSpec(mappings=ms, primary_keys=["id"], target=Target(path="/x"),
                     rules=[FilterRule("id", "greater_than", "1")])
    with pytest.raises(SpecError):
        Target(path="/x", table="t")
    ok = PipelineSpec(mappings=ms, primary_keys=["id"], target=Target(path="/x"),
                      rules=[FilterRule("id", "EQUALS", "1")])
    assert ok.mapped_columns == ["id"]


def test_from_dict():
    spec = PipelineSpec.from_dict({
        "json": {"groups": [{"path": "c", "columns": "id, amt"}], "type_overrides": [{"name": "amt", "type": "int"}]},
        "primary_keys": ["id"], "output_path": "/out", "error_path": "/err", "lookback_days": 3,
        "rules": [{"field": "amt", "operator": "in", "values": ["1", "2"]}], "params": {"threshold": "5"},
    })
    assert spec.target.path == "/out" and spec.lookback_days == 3
    assert spec.rules[0].values == ("1", "2") and spec.param("threshold") == "5" and spec.param("x", "d") == "d"
    assert [m.type for m in spec.mappings] == ["string", "int"]


def test_from_dict_new_keys():
    import datetime as _dt
    from streamload import PipelineSpec, SpecError
    base = {"primary_keys": ["id"], "json": {"groups": [{"path": "", "columns": "id, amt"}],
                                             "type-overrides": [{"name": "amt", "type": "int"}]},
            "target": {"path": "/x"}}
    spec = PipelineSpec.from_dict(dict(base, restrict_existing=False, on_type_mismatch="error", as_of="2024-01-30"))
    assert spec.restrict_existing is False and spec.on_type_mismatch == "error"
    assert spec.as_of == _dt.datetime(2024, 1, 30) and [m.type for m in spec.mappings] == ["string", "int"]
    with pytest.raises(SpecError):
        PipelineSpec.from_dict(dict(base, on_type_mismatch="sometimes"))
