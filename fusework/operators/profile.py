"""Profiling and diagnosis as long (metric, value) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fusework.functions.numbers import percent, percent_true
from fusework.functions import parse as P
from fusework.functions.text import normalize_basic_text
from fusework.operators.dedup import count_duplicates, keep_first

#: Smallest hashes that a stored sketch of a column keeps.
SKETCH = 4096


def metrics(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """All aggregates in one pass, then turned into rows ``(metric, value)``."""
    one = df.agg(*[e.cast("double").alias(n) for n, e in exprs.items()])
    return one.unpivot([], list(exprs), "metric", "value")


def scalar_metric(name: str, one: DataFrame, column: str) -> DataFrame:
    return one.select(F.lit(name).alias("metric"), F.col(column).cast("double").alias("value"))


def _text(name: str, dtype: str) -> Column:
    """One text per value, so that columns of any type can share one grouping."""
    c = F.col(name)
    return F.to_json(c) if dtype.startswith(("array", "struct", "map")) else c.cast("string")


def column_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form ``(keep..., column, value)`` of the chosen columns."""
    types = dict(df.dtypes)
    texts = df.select(*keep, *[_text(c, types[c]).alias(c) for c in columns])
    return texts.unpivot(list(keep), list(columns), "column", "value")


def profile_columns(
    df: DataFrame, source: str, order_by: str | None = None, approximate: bool = False
) -> DataFrame:
    """Per column: type, rows, nulls, distinct values and, given an order, three sample values.

    Columns whose name starts with an underscore are technical and left out.
    """
    columns = [c for c in df.columns if not c.startswith("_")]
    types = dict(df.dtypes)
    if approximate:
        # one sketch per column, no shuffle of values
        one = df.agg(
            F.count(F.lit(1)).alias("__rows"),
            *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)],
            *[F.approx_count_distinct(c).alias(f"d_{i}") for i, c in enumerate(columns)],
        )
        packed = F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col("__rows").alias("n_rows"),
                     F.col(f"n_{i}").alias("n_not_null"), F.col(f"d_{i}").alias("n_unique"))
            for i, c in enumerate(columns)
        ]))
        stats = one.select(packed.alias("p")).select("p.*")
    else:
        grouped = column_values(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        stats = grouped.groupBy("column").agg(
            F.sum("n").alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("n_not_null"),
            F.count("value").alias("n_unique"),
        )
    type_of = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    report = stats.select(
        F.lit(source).alias("source"),
        "column",
        F.element_at(type_of, F.col("column")).alias("dtype"),
        "n_rows",
        (F.col("n_rows") - F.col("n_not_null")).alias("n_null"),
        percent(F.col("n_rows") - F.col("n_not_null"), F.col("n_rows")).alias("null_pct"),
        "n_not_null",
        "n_unique",
        F.when(
            F.col("n_not_null") > 0, percent(F.col("n_unique"), F.col("n_not_null"))
        ).alias("unique_pct_over_not_null"),
    )
    if order_by is None:
        return report
    data = [c for c in columns if c != order_by]
    keyed = column_values(df, data, keep=[order_by]).where(F.col("value").isNotNull())
    first = keep_first(keyed, ["column"], [F.col(order_by).asc()], n=3)
    samples = first.groupBy("column").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(order_by, "value"))), lambda s: s["value"]
        ).alias("sample_values")
    )
    return report.join(samples, "column", "left")


def column_sketches(df: DataFrame, source: str, load: str, size: int = SKETCH) -> DataFrame:
    """A row per column of one load: source, load, column, dtype, n_rows, n_not_null, hashes.

    ``hashes`` are the ``size`` smallest different hashes of the column's values. Rows of several loads of a source are
    merged by :func:`profile_from_sketches`, whose result is that of one pass over all of them.
    """
    columns = [c for c in df.columns if not c.startswith("_")]
    types = dict(df.dtypes)
    values = column_values(df, columns).select("column", F.when(F.col("value").isNotNull(), F.xxhash64("value")).alias("hash"))
    counts = values.groupBy("column").agg(F.count(F.lit(1)).alias("n_rows"), F.count("hash").alias("n_not_null"))
    # equal values share a rank, so each task sends ``size`` different hashes a column at most
    smallest = keep_first(values.where(F.col("hash").isNotNull()).distinct(), ["column"], ["hash"], n=size)
    held = smallest.groupBy("column").agg(F.sort_array(F.collect_list("hash")).alias("hashes"))
    known = df.sparkSession.createDataFrame([(c, types[c]) for c in columns], "column string, dtype string")
    none = F.array().cast("array<bigint>")
    return known.join(counts, "column", "left").join(held, "column", "left").select(
        F.lit(source).alias("source"), F.lit(load).alias("load"), "column", "dtype",
        F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"), F.coalesce("n_not_null", F.lit(0)).cast("long").alias("n_not_null"),
        F.coalesce("hashes", none).alias("hashes"),
    )


def profile_from_sketches(sketches: DataFrame, size: int = SKETCH) -> DataFrame:
    """The column report of all loads of each source, from stored sketches alone.

    ``n_unique`` is exact for fewer than ``size`` different values; else the share of the hash range that the ``size`` smallest
    hashes take says how many there are (about 1.6 % off, at 4,096). A load given twice counts once.
    """
    loads = sketches.dropDuplicates(["source", "load", "column"])
    sums = loads.groupBy("source", "column").agg(
        F.max("dtype").alias("dtype"), F.sum("n_rows").alias("n_rows"), F.sum("n_not_null").alias("n_not_null")
    )
    hashes = loads.select("source", "column", F.explode("hashes").alias("hash")).distinct()
    smallest = keep_first(hashes, ["source", "column"], ["hash"], n=size)
    held = smallest.groupBy("source", "column").agg(F.count(F.lit(1)).alias("held"), F.max("hash").alias("last"))
    # the place of the last hash in the range from 0 to 1
    share = (F.col("last").cast("double") + float(1 << 63)) / float(1 << 64)
    unique = F.when(F.col("held") < size, F.col("held")).otherwise(F.round((size - 1) / share).cast("long"))
    report = sums.join(held, ["source", "column"], "left").withColumn("n_unique", F.coalesce(unique, F.lit(0)).cast("long"))
    return report.select(
        "source", "column", "dtype", "n_rows", (F.col("n_rows") - F.col("n_not_null")).alias("n_null"),
        percent(F.col("n_rows") - F.col("n_not_null"), F.col("n_rows")).alias("null_pct"), "n_not_null", "n_unique",
        F.when(F.col("n_not_null") > 0, percent(F.col("n_unique"), F.col("n_not_null"))).alias("unique_pct_over_not_null"),
    )


def summarize_table(df: DataFrame, label: str) -> DataFrame:
    nulls = sum(F.count_if(F.col(c).isNull()) for c in df.columns)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), nulls.alias("null_cells")).select(
        F.lit(label).alias("label"), "n_rows", F.lit(len(df.columns)).alias("n_cols"), "null_cells"
    )


def top_value_counts(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n most frequent values, NULL included; ties by value."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return (
        counts.orderBy(F.desc("count"), F.asc_nulls_last("value"))
        .limit(n)
        .withColumn("pct", percent(F.col("count"), total, 2))
    )


def null_pct_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    one = df.agg(
        *[percent_true(F.col(c).isNull()).alias(c) for c in present]
    )
    return one.unpivot([], present, "column", "null_pct")


def diagnose_catalog_a(raw: DataFrame) -> DataFrame:
    """Known defects of source A."""
    data = raw.drop("row_id")
    number = {c: P.numeric_coerce(F.col(c)) for c in data.columns}
    exprs = {"n_rows": F.count(F.lit(1)), "n_cols": F.lit(len(data.columns))}
    if "runtime" in data.columns:
        r = number["runtime"]
        exprs |= {
            "runtime_null": F.count_if(r.isNull()),
            "runtime_zero": F.count_if(r == 0),
            "runtime_gt_600": F.count_if(r > 600),
        }
    for c in ("revenue", "budget"):
        if c in data.columns:
            exprs |= {f"{c}_negative": F.count_if(number[c] < 0), f"{c}_zero": F.count_if(number[c] == 0)}
    if "vote_average" in data.columns:
        v = number["vote_average"]
        exprs |= {
            "vote_average_zero": F.count_if(v == 0),
            "vote_average_out_of_range": F.count_if((v < 0) | (v > 10)),
        }
    if "vote_count" in data.columns:
        exprs |= {"vote_count_zero": F.count_if(number["vote_count"] == 0)}
    parts = [metrics(data, exprs), scalar_metric("duplicated_rows", count_duplicates(data), "n_duplicates")]
    if "id" in data.columns:
        parts.append(scalar_metric("duplicated_id", count_duplicates(data, ["id"]), "n_duplicates"))
    if {"title", "release_date"} <= set(data.columns):
        keyed = data.select(
            normalize_basic_text(F.col("title")).alias("t"),
            F.year(P.parse_date(F.col("release_date").cast("string"))).alias("y"),
        )
        parts.append(scalar_metric("duplicated_title_year", count_duplicates(keyed), "n_duplicates"))
    return _union(parts)


def diagnose_catalog_b(raw: DataFrame) -> DataFrame:
    """Known defects of source B."""
    data = raw.drop("row_id", "src_key")
    exprs = {"n_rows": F.count(F.lit(1)), "n_cols": F.lit(len(data.columns))}
    if "year" in data.columns:
        exprs |= {"year_negative": F.count_if(P.numeric_coerce(F.col("year")) < 0)}
    if "run_time" in data.columns:
        text = F.lower(F.col("run_time").cast("string"))
        exprs |= {
            "run_time_missing": F.count_if(F.col("run_time").isNull()),
            "run_time_not_released": F.count_if(text.contains("not-released")),
            "run_time_contains_money": F.count_if(text.contains("$")),
        }
    if "rating" in data.columns:
        r = P.numeric_coerce(F.col("rating"))
        exprs |= {
            "rating_not_numeric": F.count_if(r.isNull()),
            "rating_out_of_range": F.count_if((r < 0) | (r > 10)),
        }
    parts = [metrics(data, exprs), scalar_metric("duplicated_rows", count_duplicates(data), "n_duplicates")]
    if {"movie_title", "year"} <= set(data.columns):
        keyed = data.select(
            normalize_basic_text(F.col("movie_title")).alias("t"),
            F.abs(P.numeric_coerce(F.col("year"))).alias("y"),
        )
        parts.append(scalar_metric("duplicated_title_year", count_duplicates(keyed), "n_duplicates"))
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Issue, metric of source A (none: always 0), metric of source B.
INITIAL_ISSUES = (
    ("title", "duplicated_title_year", "duplicated_title_year"),
    ("year", None, "year_negative"),
    ("runtime", "runtime_zero", "run_time_not_released"),
    ("rating", "vote_count_zero", "rating_not_numeric"),
)


def initial_issues_comparison(diagnosis_a: DataFrame, diagnosis_b: DataFrame) -> DataFrame:
    """Issue rates of both sources side by side, in percent of their rows."""

    def rates(d: DataFrame, which: int, name: str) -> DataFrame:
        def value(metric: str | None) -> Column:
            return F.max(F.when(F.col("metric") == metric, F.col("value"))) if metric else F.lit(0.0)

        one = d.agg(*[
            F.round(100 * value(row[which]) / value("n_rows"), 4).alias(row[0]) for row in INITIAL_ISSUES
        ])
        return one.unpivot([], [row[0] for row in INITIAL_ISSUES], "issue", name)

    return rates(diagnosis_a, 1, "pct_a").join(rates(diagnosis_b, 2, "pct_b"), "issue")
