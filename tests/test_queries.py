"""Every registered query against its DuckDB SQL over the smallest test data."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_point
from skyledger.catalog import QUERIES
from skyledger.oracle import ORACLE_SQL
from skyledger.plans.reports import DELAY_FIELDS

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("nation", "supplier", "part", "lineitem")
TYPES = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "int": "INTEGER",
    "string": "VARCHAR",
}


@pytest.fixture(scope="module")
def oracle():
    with duckdb.connect() as connection:
        for table in TABLES:
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'"
            )
        yield connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert ORACLE_SQL.items() <= entry_point.oracle_sql().items()


@pytest.mark.parametrize("key", QUERIES)
def test_query_agrees_with_sql(spark, oracle, key):
    df = entry_point.queries()[key](spark, SF_DIR)
    cursor = oracle.execute(entry_point.oracle_sql()[key])
    types = {column[0]: str(column[1]) for column in cursor.description}
    assert {name: TYPES[kind] for name, kind in df.dtypes} == types
    expected = [dict(zip(types, row)) for row in cursor.fetchall()]
    found = [row.asDict() for row in df.collect()]
    columns = sorted(types)

    def ordered(rows):
        return sorted((tuple(row[c] for c in columns) for row in rows), key=repr)

    assert ordered(found) == ordered(expected)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == list(DELAY_FIELDS)
    assert df.count() > 0
