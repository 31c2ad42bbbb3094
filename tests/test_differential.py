"""Every registered query against the same query in SQL on another engine."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from stratamart.registry.queries import QUERIES
from tests.conftest import TESTDATA

SCALE = os.environ.get("TEST_SF", "0.01")
SF_DIR = f"{TESTDATA}/sf{SCALE}"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    yield connection
    connection.close()


def _sortable(row):
    return tuple((value is not None, str(type(value)), value) for value in row)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=_sortable)


# Spark type -> the type the other engine reports for an equal column.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    expected = duck.execute(oracle_sql()[name])
    names = [column[0] for column in expected.description]
    types = {column[0]: str(column[1]) for column in expected.description}
    assert sorted(df.columns) == sorted(names)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    ours, theirs = _rows(df.columns, df.collect()), _rows(names, expected.fetchall())
    assert len(ours) == len(theirs)
    for left, right in zip(ours, theirs):
        assert left == right


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
