"""Every registered query against its SQL, on whole tables."""

import __spark_entry__ as entry_point
import pytest
from compare import duckdb_views, spark_rows, sql_rows

QUERIES = {name: entry_point.queries()[name] for name in entry_point.LIBRARY_QUERIES}
SQL = {name: sql for name, sql in entry_point.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duckdb_views(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, connection, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = sql_rows(connection, SQL[name])
    assert columns == expected_columns
    assert len(rows) > 0
    assert rows == expected


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).columns[0] == "line_id"
