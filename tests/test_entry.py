"""The driver contract: entry() runs, and every query equals its DuckDB oracle on sf0.001."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

TABLES = "events conversations lineitem".split()


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v.replace(tzinfo=None) if getattr(v, "tzinfo", None) else v)
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    if isinstance(v, bytearray):
        return bytes(v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), Counter(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_id", "event_timestamp", "user_id", "event_type", "value", "k", "audit_load_date"]


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) == set(E.ORACLES)
    assert set(E.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_optional_modules():
    assert E._optional("streamload.no_such_package.queries") is None
    assert E._optional("streamload.workspace") is not None


@pytest.mark.parametrize("name, batches", [("progress_totals", 4), ("stream_available_now", 4), ("progress_table", 3)])
def test_a_backlog_is_as_many_batches_whatever_its_files(spark, workdir, monkeypatch, name, batches):
    spark.sql("""SELECT id AS event_id, timestamp_ntz'2024-01-28' + make_interval(0, 0, 0, 0, CAST(id % 60 AS INT)) AS ts, id % 7 AS user_id,
                 CASE WHEN id % 5 = 0 THEN 'error' ELSE 'view' END AS event_type, CAST(id AS DOUBLE) AS value, '{"k": 1}' AS props
                 FROM range(240)""").write.parquet(f"{workdir}/events.parquet")
    seen, real = [], E.run_stream

    def counted(source, spec, *, on_metrics=None, **kw):
        return real(source, spec, on_metrics=lambda m: (seen.append(m.n_in), on_metrics and on_metrics(m)), **kw)
    monkeypatch.setattr(E, "run_stream", counted)
    monkeypatch.setattr(E, "_files", lambda *a: 24)
    assert E.queries()[name](spark, workdir).count() > 0
    assert len(seen) == batches and sum(seen) == E._msgs(spark, workdir).count()


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert canon(df.columns, rows) == canon(cols, res.fetchall())
