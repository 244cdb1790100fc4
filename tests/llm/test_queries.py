"""Registered queries: columns, and SQL where there is some."""

import os

import duckdb
import pytest

from parchment.llm.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    found = con.execute(SQL[name])
    names = [d[0] for d in found.description]
    df = QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(names)
    assert sorted(str(tuple(r)) for r in df.select(names).collect()) == sorted(map(str, found.fetchall()))


def test_ten():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
