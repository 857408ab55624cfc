"""Every registered query against its SQL."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tallymart.oracle import ORACLE
from tallymart.registry import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(row[i] for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF)
    expected = duck.execute(ORACLE[name])
    columns, rows = by_name(result.columns, map(tuple, result.collect()))
    expected_columns, expected_rows = by_name(
        [d[0] for d in expected.description], expected.fetchall())
    assert columns == expected_columns
    assert rows - expected_rows == Counter()
    assert expected_rows - rows == Counter()
    assert rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0
