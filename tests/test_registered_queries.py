"""Every registered query against its SQL twin."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as book
from querybook.oracle import ORACLE
from querybook.queries import QUERIES


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(book.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, database, sf_dir, name):
    df = book.queries()[name](spark, sf_dir)
    ours = rows_by_name(df.columns, df.collect())
    cursor = database.execute(book.oracle_sql()[name])
    theirs = rows_by_name([c[0] for c in cursor.description], cursor.fetchall())
    assert ours == theirs


def test_entry(spark):
    assert book.entry(spark).count() == 4
