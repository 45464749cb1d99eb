"""Every registered query against its DuckDB restatement (small scale; tools/check_oracle.py runs sf0.01)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from audit_rows import OWN, SF_SMALL

QUERIES = {k: v for k, v in E.queries().items() if k in OWN}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in OWN}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((repr(tuple(_norm(r[i]) for i in order)) for r in rows))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for table in ("events", "supplier"):
        c.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_SMALL}/{table}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(ocols, res.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "ai_comprehensive_analysis" in df.columns
