"""CSV catalogues in, tables out."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fusework.config import CSV_NA_VALUES
from fusework.session import StageStore
from fusework.sources.csv_records import read_records


def snake_case(name: str) -> str:
    words = re.sub(r"[\s\-]+", "_", name.strip().lower())
    return re.sub(r"_+", "_", re.sub(r"[^a-z0-9_]", "", words)).strip("_")


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])


def _missing_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(~F.col(c).isin(*CSV_NA_VALUES), F.col(c)).alias(c) for c in df.columns])


def load_csv_source(
    spark: SparkSession,
    path: str,
    label: str,
    backslash_escapes: bool = False,
    multi_line: bool = False,
    row_id: str | None = None,
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """All columns as text, snake_case names, ``_source`` added.

    ``backslash_escapes`` reads the dialect that both doubles quotes and escapes them with a
    backslash; Spark's reader knows one escape only, so escapes are rewritten line by line first.
    ``multi_line`` reads records with line breaks inside quotes, in both dialects; ``row_id`` names a column with the number of
    each record, from 0 in the order of the files, and implies it; the records are then stored by ``stage``, or in a folder of
    their own. Files stay splittable either way. A broken
    record fails the job: too many fields, or a quoted field that a file's end leaves open; missing fields are NULL there.
    """
    if multi_line or row_id:
        return _load_records(spark, path, label, backslash_escapes, row_id, stage or StageStore(spark).save)
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("mode", "FAILFAST")
    if not backslash_escapes:
        df = reader.option("inferSchema", False).csv(path)
        return _missing_to_null(snake_case_columns(df)).withColumn("_source", F.lit(label))
    # the header alone names the columns
    names = reader.option("inferSchema", False).csv(path).columns
    schema = T.StructType([T.StructField(snake_case(n), T.StringType()) for n in names])
    line = F.col("value")
    for pattern, replacement in (
        (r"\\\\", "\u0001"),  # an escaped backslash, kept aside
        (r'\\"', '""'),
        (r"\\(.)", "$1"),
        ("\u0001", r"\\"),
    ):
        line = F.regexp_replace(line, pattern, replacement)
    # every file starts with the same header line; it is recognised by its parsed first columns
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST", "header": "false"}
    rows = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    parsed = rows.select(F.from_csv(line, schema.simpleString()[7:-1].replace(":", " "), options).alias("r"))
    is_header = F.lit(True)
    for field, name in zip(schema.fieldNames(), names):
        is_header = is_header & F.col(f"r.{field}").eqNullSafe(F.lit(name))
    return _missing_to_null(parsed.where(~is_header).select("r.*")).withColumn("_source", F.lit(label))


def _load_records(spark: SparkSession, path: str, label: str, backslash: bool, row_id: str | None, stage) -> DataFrame:
    records = read_records(spark, path, stage, backslash, header=True, name=f"csv_records_{label}")
    header = records.where("record = 0").orderBy("file").limit(1).first()
    if header is None:
        raise ValueError(f"{path} has no header")
    names = [snake_case(n.removeprefix("\ufeff")) for n in header.fields]
    many = F.raise_error(F.concat(F.lit("a record with too many fields in "), F.col("file"), F.lit(": "), F.col("record").cast("string")))
    fields = F.when(F.size("fields") > len(names), many.cast("array<string>")).otherwise(F.col("fields"))
    rows = records.where("record > 0").withColumn("fields", fields)
    values = rows.select(*[F.get("fields", i).alias(n) for i, n in enumerate(names)], F.col("number").alias("__number"))
    return values.select(
        *[F.when(~F.col(n).isin(*CSV_NA_VALUES), F.col(n)).alias(n) for n in names],
        F.lit(label).alias("_source"), *([F.col("__number").alias(row_id)] if row_id else []),
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> str:
    """Overwrites the folder; partitions are written where they are."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def reload_master(spark: SparkSession, path: str) -> DataFrame:
    """The stored master table; a missing one is an error that names the path."""
    return spark.read.parquet(path)


def reload_clean_inputs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored clean tables and matches."""
    return tuple(spark.read.parquet(f"{root}/{name}") for name in ("clean_a", "clean_b", "matches"))


def write_match_audit(matches: DataFrame, path: str) -> str:
    """All matches in one table, one folder per status: each review set is a pruned read."""
    return write_table(matches, path, partition_by=("match_status",))
