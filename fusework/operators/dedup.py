"""Duplicates: keep one row per key, count what is surplus.

``row_number() = 1`` lets Spark put a WindowGroupLimit below the shuffle, so every map task sends
at most one row per key: a key that holds a third of the table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key. ``order`` must end in a unique column."""
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(window))
    return ranked.where(F.col("__rank") <= n).drop("__rank")


def dedup_by_key(df: DataFrame, key: str, row_id: str) -> DataFrame:
    return keep_first(df, [key], [F.col(row_id).asc()])


def text_digest(text: Column) -> Column:
    """A 256-bit stand-in for long texts as keys: the shuffle carries 64 characters per row."""
    return F.sha2(text, 256)


def dedup_best_record(
    df: DataFrame, keys: Sequence[str], evidence: Sequence[Column], row_id: str
) -> DataFrame:
    """Per key the row for which most of the ``evidence`` conditions hold."""
    quality = sum(F.coalesce(e, F.lit(False)).cast("int") for e in evidence)
    return keep_first(df, keys, [quality.desc(), F.col(row_id).asc()])


def count_duplicates(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: rows, distinct keys and the surplus. NULL equals NULL."""
    groups = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        (F.coalesce(F.sum("__n"), F.lit(0)) - F.count(F.lit(1))).alias("n_duplicates"),
    )
