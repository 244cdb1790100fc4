"""Each query of the catalog against its SQL on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

from parchment import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def norm(v):
    if isinstance(v, float):
        return None if v != v else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v.isoformat() if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_as_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    mine = sorted(str([norm(r[c]) for c in columns]) for r in df.collect())
    found = duck.execute(catalog.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    theirs = sorted(str([norm(r[names.index(c)]) for c in columns]) for r in found.fetchall())
    assert mine == theirs and mine


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0 and set(e.oracle_sql()) <= set(e.queries())
