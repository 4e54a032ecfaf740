"""Every registered query against its DuckDB oracle at sf0.001 (the driver's gate)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from tablecare.plans.catalog import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, got) == canon(ocols, want)


def test_entry_anchor(spark):
    r = E.entry(spark).collect()[0]
    assert (r.total_rows, r.clean_rows, r.quarantine_rows) == (1650, 711, 939)
