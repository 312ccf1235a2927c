"""Every registered query against its SQL, on the smallest sample tables."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return float(value) if isinstance(value, Decimal) else value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(normal(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(lines, key=repr)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_agrees_with_sql(spark, database, name):
    frame = entry_points.queries()[name](spark, FOLDER)
    result = database.execute(entry_points.oracle_sql()[name])
    expected = table([c[0] for c in result.description], result.fetchall())
    assert expected[1] or name == "flatten_skip_empty"
    assert table(frame.columns, frame.collect()) == expected


@pytest.mark.parametrize("name", ["stored_round_trip", "difference_of_pieces"])
def test_longer_documents_agree_as_well(spark, name):
    """One of the larger samples' documents has a paragraph of over 5,000 words."""
    connection = duckdb.connect()
    folder = "/root/testdata/sf0.01"
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    frame = entry_points.queries()[name](spark, folder)
    result = connection.execute(entry_points.oracle_sql()[name])
    expected = table([c[0] for c in result.description], result.fetchall())
    assert table(frame.columns, frame.collect()) == expected


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
