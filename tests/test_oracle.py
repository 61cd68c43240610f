"""Every registered query against its DuckDB oracle on the sf0.01 tables."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_ORACLE

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_ORACLE)
    cols, got = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(got) == len(want)
    assert _canon(cols, got) == _canon(ocols, want)
