"""Every registered query against its DuckDB oracle on the smallest scale (sf0.001)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from delaylens.plans.catalog import load_all

SMOKE = "/root/testdata/sf0.001"
TABLES = ["lineitem", "supplier", "events", "orders", "customer", "part", "nation", "region"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr), [cols[i] for i in order]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "station_code" in df.columns


@pytest.mark.parametrize("name", sorted(n for n, r in load_all().items() if r.oracle is not None))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SMOKE)
    s_rows, s_cols = _rows(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = duck.execute(entry.oracle_sql()[name])
    d_rows, d_cols = _rows([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows
