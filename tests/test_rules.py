import pytest

from streamload import FilterRule, SpecError
from streamload.operators import apply_rules, build_condition

ROWS = [("a", "US", 30, None), ("b", "CA", 5, "x"), ("c", None, None, "y"), ("d", "US", 60, None)]
SCHEMA = "id string, country string, n int, closed string"


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def ids(df, rules):
    return sorted(r["id"] for r in apply_rules(df, rules).collect())


@pytest.mark.parametrize("rule,expected", [
    (FilterRule("country", "equals", "US"), ["a", "d"]),
    (FilterRule("n", "equals", "030"), ["a"]),                 # literal cast to the column type
    (FilterRule("country", "not_equals", "US"), ["b"]),        # NULL dropped
    (FilterRule("n", "not_equals", "30"), ["b", "d"]),
    (FilterRule("country", "in", values=["CA", "MX"]), ["b"]),
    (FilterRule("n", "in", values=["030", "60"]), ["a", "d"]),
    (FilterRule("country", "not_in", values=["CA"]), ["a", "d"]),
    (FilterRule("n", "not_in", values=["5"]), ["a", "d"]),
    (FilterRule("closed", "is_null"), ["a", "d"]),
    (FilterRule("closed", "is_not_null"), ["b", "c"]),
    (FilterRule("country", "in", values=[]), []),
    (FilterRule("country", "not_in", values=[]), ["a", "b", "d"]),
    (FilterRule("country", "EQUALS", "US"), ["a", "d"]),        # operator names are case-insensitive
])
def test_single_rule(df, rule, expected):
    assert ids(df, [rule]) == expected


def test_conjunction_and_identity(df):
    assert ids(df, []) == ["a", "b", "c", "d"]
    assert ids(df, [FilterRule("country", "equals", "US"), FilterRule("closed", "is_null"),
                    FilterRule("n", "not_in", values=["60"])]) == ["a"]


@pytest.mark.parametrize("rule", [
    FilterRule("country", "equals"),                 # missing value
    FilterRule("country", "in"),                     # missing values
    FilterRule("country", "like", "U%"),             # unknown operator
    FilterRule("n", "equals", "abc"),                # literal not an int
    FilterRule("nope", "is_null"),                   # unknown column
])
def test_rule_errors(df, rule):
    with pytest.raises(SpecError):
        build_condition(rule, df.schema)


def test_same_result_with_ansi_on_and_off(spark, df):
    rules = [FilterRule("n", "in", values=["030", "5"]), FilterRule("country", "not_in", values=[])]
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        off = ids(df, rules)
        spark.conf.set("spark.sql.ansi.enabled", "true")
        on = ids(df, rules)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert off == on == ["a", "b"]
