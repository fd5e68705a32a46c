"""Every registered query against DuckDB on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from conftest import SMALL, TABLES
from deskweave.plans import catalog, checks

QUERIES = catalog.all_queries()
SQL = checks.all_checks()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def test_every_check_has_a_query():
    assert set(SQL) <= set(QUERIES)
    # an approximate search has no SQL; tests/test_vector_index.py measures its recall
    assert set(QUERIES) - set(SQL) == {"vector_index_topk"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    found = duck.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = [tuple(plain(r[i]) for i in at) for r in found.fetchall()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
