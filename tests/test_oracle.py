"""Every query with a SQL twin gives the twin's rows at the smallest scale."""

import datetime
import glob
import os

import duckdb
import pytest

from framewright.plans import catalog

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(path).split('.')[0]} AS SELECT * FROM '{path}'")
    return c


def plain(x):
    if isinstance(x, (list, tuple)):
        return str([plain(y) for y in x])
    if isinstance(x, bool) or x is None:
        return str(x)
    if isinstance(x, float):
        return repr(x)
    if isinstance(x, datetime.date):
        return x.isoformat()
    return str(x)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    mine = sorted(tuple(plain(r[c]) for c in columns) for r in got.collect())
    theirs = sorted(tuple(plain(r[want.columns.index(c)]) for c in columns) for r in want.fetchall())
    assert mine == theirs
