"""Every registered query against its SQL on the smallest test tables."""

import math
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")

from workload.catalog import QUERIES, SQL  # noqa: E402


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def ordered(rows, columns):
    places = sorted(range(len(columns)), key=lambda place: columns[place])
    return sorted(tuple(repr(row[place]) for place in places) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, database, name):
    df = QUERIES[name](spark, str(FOLDER))
    expected = database.execute(SQL[name])
    columns = [entry[0] for entry in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert ordered(df.collect(), df.columns) == ordered(expected.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    rows = QUERIES[name](spark, str(FOLDER)).collect()
    assert rows
    for row in rows:
        assert not any(isinstance(value, float) and math.isnan(value) for value in row)


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)
