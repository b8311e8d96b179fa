"""Every registered query against the same result in SQL, run by another engine."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from acceptance import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    got = queries()[name](spark, SF_DIR)
    expected = duck.execute(oracle_sql()[name])
    names = [column[0] for column in expected.description]
    assert sorted(got.columns) == sorted(names)
    assert _rows(got.columns, got.collect()) == _rows(names, expected.fetchall())


def test_entry(spark):
    counted = entry(spark)
    assert counted.columns[0] == "batch_id" and counted.count() == 2557
