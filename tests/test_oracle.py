"""Every registered query against its SQL on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["pages", "customer", "documents", "supplier", "orders"]
# Queries that the entry file takes from elsewhere have tests of their own.
QUERIES = [name for name, query in contract.queries().items() if query.__module__ == contract.__name__]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(row[i] for i in order) for row in rows], key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    result = duck.sql(contract.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(result.columns)
    expected = rows_of(result.columns, result.fetchall())
    assert expected
    assert rows_of(frame.columns, frame.collect()) == expected
    types = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "string": "VARCHAR",
        "double": "DOUBLE",
        "boolean": "BOOLEAN",
        "timestamp": "TIMESTAMP",
    }
    spark_types = {column: types[kind] for column, kind in frame.dtypes}
    assert spark_types == dict(zip(result.columns, map(str, result.types)))


def test_entry(spark):
    assert {row["lang"] for row in contract.entry(spark).collect()} == {"en", "de", "fr", "es"}
