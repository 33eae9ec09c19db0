"""Every registered query against its DuckDB oracle on sf0.001 (the driver uses sf0.01)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tessera.sources.tables import TABLES, table_path

SLOW: set = set()   # partitioned_matches writes ~1.5k tiny files here (~30 s); kept in


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return round(float(v), 4)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _canon(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rs), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return c


def test_registry_is_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 45


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - SLOW))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    rel = con.execute(E.oracle_sql()[name])
    o_cols = [d[0] for d in rel.description]
    o_rows = rel.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert _canon(s_cols, s_rows) == _canon(o_cols, o_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["o_custkey", "class", "is_active", "start_year", "end_year",
                          "current_year"]
