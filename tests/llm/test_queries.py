"""Registered queries against their SQL."""

import os

import duckdb
import pytest

from sheafwork.llm import queries
from tests.llm.data import SF_DIR
from tests.test_oracle import rows_of


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query(spark, name):
    frame = queries.QUERIES[name](spark, SF_DIR)
    duck = duckdb.connect()
    for file in os.listdir(SF_DIR):
        view = file.removesuffix(".parquet")
        duck.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{SF_DIR}/{file}')")
    cursor = duck.execute(queries.ORACLE_SQL[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(columns, cursor.fetchall()) == rows_of(frame.columns, frame.collect())
