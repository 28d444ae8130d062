"""Every registered query gives the rows of its SQL, on whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from careledger.queries.base import BASE, ORACLES, QUERIES

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in BASE:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def normal(value):
    return round(value, 6) if isinstance(value, float) else value


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, db, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = rows(df.columns, df.collect())
    result = db.sql(entry.oracle_sql()[name])
    want = rows(result.columns, result.fetchall())
    assert sorted(df.columns) == sorted(result.columns)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == w
    assert got, "a query without rows checks nothing"


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
