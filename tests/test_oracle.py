"""Every registered query against its DuckDB definition, value by value."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver
import oracles

SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert driver.own_queries().keys() == oracles.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(driver.own_queries()))
def test_query(spark, oracle, name):
    frame = driver.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    rows = [tuple(row) for row in frame.select(*columns).collect()]
    relation = oracle.sql(oracles.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    expected = oracle.sql(f"SELECT {', '.join(columns)} FROM ({oracles.oracle_sql()[name]})").fetchall()
    assert rows
    assert sorted(map(repr, rows)) == sorted(map(repr, expected))


def test_entry(spark):
    frame = driver.entry(spark)
    assert len(frame.columns) == 15
    assert frame.count() == 2
