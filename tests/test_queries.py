"""Every registered query with SQL gives the same rows on DuckDB."""

import glob
import os

import duckdb
import pytest

from check import rows_of
from oracles.registry import QUERIES, SQL


@pytest.fixture(scope="session")
def db(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, db, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = db.execute(SQL[name])
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in result.description], result.fetchall())


def test_every_query_is_listed_by_the_entry_point():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
