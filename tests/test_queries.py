"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import datetime
import math

import duckdb
import pytest

import lattik.queries as engine

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
engine.load()


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    return value.isoformat() if isinstance(value, (datetime.datetime, datetime.date)) else str(value)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(engine.SQL))
def test_query_equals_sql(spark, duck, name):
    df = engine.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted([tuple(plain(r[c]) for c in cols) for r in df.collect()])
    answer = duck.sql(engine.SQL[name])
    assert sorted(answer.columns) == cols
    at = [answer.columns.index(c) for c in cols]
    assert got == sorted([tuple(plain(r[i]) for i in at) for r in answer.fetchall()])
