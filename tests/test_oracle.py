"""Every query with SQL against DuckDB over the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for f in os.listdir(data):
        c.sql(f"create view {f.split('.')[0]} as select * from '{data}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, duck, data, name):
    ours = entry.queries()[name](spark, data)
    cols = sorted(ours.columns)
    theirs = duck.sql(entry.oracle_sql()[name])
    assert sorted(theirs.columns) == cols
    expected = Counter(duck.sql(f"select {', '.join(cols)} from ({entry.oracle_sql()[name]})").fetchall())
    assert Counter(tuple(r) for r in ours.select(*cols).collect()) == expected


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["deploy_id", "sidechain_number", "hash", "height"]
    assert out.count() > 0
