"""Every registered query against its SQL oracle, at the smallest scale."""

from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from bindings import load

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in "region nation customer supplier part orders lineitem events".split():
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(f"{r[i]:.9g}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in data)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


def test_entry_returns_rows(spark):
    assert entry(spark).count() > 0
