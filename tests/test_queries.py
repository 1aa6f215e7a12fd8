"""Every registered query against its SQL, on the smallest tables."""

import collections
import datetime as dt

import duckdb
import pytest

from postlake.queries import QUERIES, SQL

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def plain(v):
    return round(v, 6) if isinstance(v, float) else v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    got = collections.Counter(tuple(map(plain, r)) for r in df.select(*columns).collect())
    want = duck.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    assert got == collections.Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in want.fetchall())
