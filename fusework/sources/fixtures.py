"""Two dirty catalogues derived from the ``part`` table.

The SQL uses only what Spark and DuckDB share, so both engines see the same rows.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from fusework.session import spread

_SQL = Path(__file__).with_name("sql")


def catalog_sql(name: str) -> str:
    return (_SQL / f"{name}.sql").read_text()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # a few splits hold many rows of this narrow table, and the parsers that follow cost far more than its bytes
    part = spread(table(spark, sf_dir, "part"))
    return spark.sql(catalog_sql(name).replace("FROM part", "FROM {part}"), part=part)


def cat_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "cat_a")


def cat_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "cat_b")
