"""Every registered query equals its SQL oracle (DuckDB) on the small scale."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from martwright.plans.oracle import oracle_queries
from martwright.plans.registry import all_queries

TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v != v.to_integral_value() else str(v.to_integral_value())
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(oracle_queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _canon(rows, df.columns) == _canon(res.fetchall(), cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "calendar_year", "month_name", "fiscal_year", "fiscal_quarter", "sales", "quantity_sold", "profit",
    ]
    assert df.count() > 0
