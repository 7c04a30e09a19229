"""Every registered query against its SQL in DuckDB, on the same tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        view = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def comparable(frame):
    """Rows as sorted tuples of plain values, columns in name order."""
    columns = sorted(frame.columns)
    rows = []
    for row in frame[columns].itertuples(index=False, name=None):
        rows.append(tuple(None if v is None or v is pd.NA or v != v else float(v) if isinstance(v, (int, float)) else str(v) for v in row))
    return columns, sorted(rows, key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    if name not in SQL:
        assert len(found) > 0
        return
    columns, rows = comparable(found)
    expected_columns, expected = comparable(duck.execute(SQL[name]).df())
    assert columns == expected_columns
    assert rows == expected


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == ["quantity_category", "lines", "revenue"] and frame.count() == 4
