"""Every registered query against its DuckDB twin on the sf0.001 tables."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tuplecohort.plans.queries import QUERIES, SQL

TABLES = ["orders", "lineitem", "events", "customer", "part", "supplier", "nation", "region"]


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, srows) == canon(dcols, cur.fetchall())


def test_entry_flagship(spark):
    rows = E.entry(spark).orderBy("week").collect()
    assert [r["est_keys"] for r in rows][:4] == [5.0, 7.0, 4.0, 4.0]
