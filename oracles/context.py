"""What the registered queries share: source tables and the runs staged for one data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fusework.plans.stages import CatalogRun
from fusework.session import StageStore
from fusework.sources import fixtures

_RUNS: dict[tuple[str, str, str], CatalogRun] = {}


def full_run(spark: SparkSession, sf_dir: str) -> CatalogRun:
    """All three layers and the isolation forest."""
    key = (spark.sparkContext.applicationId, sf_dir, "full")
    if key not in _RUNS:
        _RUNS[key] = CatalogRun(
            fixtures.cat_a(spark, sf_dir), fixtures.cat_b(spark, sf_dir), StageStore(spark)
        )
    return _RUNS[key]


def sql_run(spark: SparkSession, sf_dir: str) -> CatalogRun:
    """The same run, matches and golden records; its flags leave out the isolation forest, which draws random numbers."""
    key = (spark.sparkContext.applicationId, sf_dir, "sql")
    if key not in _RUNS:
        _RUNS[key] = full_run(spark, sf_dir).variant("without_forest", isolation=False)
    return _RUNS[key]


def flat(df: DataFrame) -> DataFrame:
    """Arrays and dates as text, so that both engines hand out the same plain values."""

    def column(name: str, dtype: str) -> Column:
        if dtype == "array<string>":
            return F.array_join(name, "|").alias(name)
        if dtype == "date":
            return F.col(name).cast("string").alias(name)
        return F.col(name)

    return df.select(*[column(n, t) for n, t in df.dtypes])


def truth_pairs(run: CatalogRun) -> DataFrame:
    """Cleaned rows of both sources that stand for the same item, as structs a and b."""
    a = run.clean_a.select("a_row_id", F.struct("*").alias("a"))
    b = run.clean_b.select(
        (F.col("b_row_id") % 1_000_000_000).alias("a_row_id"), "b_row_id", F.struct("*").alias("b")
    )
    return a.join(b, "a_row_id")
