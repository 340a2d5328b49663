"""Reports on the finished master table and the PASS/FAIL audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fusework.config import DEFAULTS, Settings
from fusework.functions.numbers import percent, percent_true
from fusework.operators.dedup import count_duplicates
from fusework.operators.link import equal_width_histogram
from fusework.operators.profile import metrics
from fusework.operators.quantiles import exact_quantiles


def record_type_summary(master: DataFrame) -> DataFrame:
    total = master.agg(F.count(F.lit(1))).scalar()
    counts = master.groupBy("record_type").agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("pct", percent(F.col("count"), total))


def coverage_summary(master: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    a, b = settings.source_a, settings.source_b

    def n(kind: str) -> Column:
        return F.count_if(F.col("record_type") == kind)

    def rate(other: str) -> Column:
        total = n("merged") + n(other)
        return F.when(total > 0, percent(n("merged"), total))

    return metrics(master, {
        "merged_records": n("merged"),
        f"{a}_only_records": n(f"{a}_only"),
        f"{b}_only_records": n(f"{b}_only"),
        "movie_master_total": F.count(F.lit(1)),
        f"{a}_fusion_rate_pct": rate(f"{a}_only"),
        f"{b}_fusion_rate_pct": rate(f"{b}_only"),
    })


def _null_cells(df: DataFrame) -> Column:
    return sum(F.count_if(F.col(c).isNull()) for c in df.columns)


def quality_before_after(raw_a: DataFrame, raw_b: DataFrame, master: DataFrame) -> DataFrame:
    def scalar(df: DataFrame, expr: Column) -> Column:
        return df.agg(expr.cast("double")).scalar()

    rows = F.count(F.lit(1))
    score = F.col("data_quality_score")
    return metrics(master, {
        "rows_before": F.max(scalar(raw_a, rows) + scalar(raw_b, rows)),
        "rows_after": rows,
        "null_cells_before": F.max(scalar(raw_a, _null_cells(raw_a)) + scalar(raw_b, _null_cells(raw_b))),
        "null_cells_after": _null_cells(master),
        "dqs_mean_after": exact_mean("data_quality_score"),
        # the score has four decimals: at most 10,001 distinct values in the buffer
        "dqs_median_after": F.round(F.median(score), 4),
        "merged_pct_after": percent_true(F.col("record_type") == "merged"),
    })


def dqs_boxplot_stats(master: DataFrame) -> DataFrame:
    """Five numbers per record type; the score has at most 10,001 distinct values."""
    five = F.percentile("data_quality_score", [0.0, 0.25, 0.5, 0.75, 1.0])
    names = ["dqs_min", "dqs_q1", "dqs_median", "dqs_q3", "dqs_max"]
    grouped = master.groupBy("record_type").agg(five.alias("p"), F.count("data_quality_score").alias("n"))
    return grouped.select("record_type", *[F.col("p")[i].alias(x) for i, x in enumerate(names)], "n")


def quality_dims_by_type(master: DataFrame) -> DataFrame:
    dims = [
        "completeness_score", "validity_score", "consistency_score", "traceability_score", "data_quality_score",
    ]
    return master.groupBy("record_type").agg(*[exact_mean(d).alias(d) for d in dims])


def exact_mean(score: str) -> Column:
    """Mean of a score of four decimals, rounded half up to four: a sum of integers has no order."""
    total, n = F.sum(F.round(F.col(score) * 10000).cast("long")), F.count(score)
    return F.floor((2 * total + n) / (2 * n)) / 10000


def winsor_histogram(df: DataFrame, column: str, low: float = 0.01, high: float = 0.99, bins: int = 50) -> DataFrame:
    """Histogram of the column with its tails clipped to two quantiles."""
    rows = df.where(F.col(column).isNotNull()).select(column)
    # two numbers; as a scalar subquery they would be planned again in each of the many places that the histogram reads them
    lowest, highest = (F.lit(x).cast("double") for x in exact_quantiles(rows, column, {"lo": low, "hi": high}).select("lo", "hi").first())
    clipped = rows.select(F.greatest(F.least(F.col(column), highest), lowest).alias(column))
    return equal_width_histogram(clipped, column, bins)


def log_scatter_points(master: DataFrame) -> DataFrame:
    both = master.where(F.col("budget_usd").isNotNull() & F.col("revenue_usd").isNotNull())
    flag = [F.col("multivariate_outlier_iso")] if "multivariate_outlier_iso" in master.columns else []
    return both.select(
        "movie_master_id",
        F.log1p("budget_usd").alias("log_budget"),
        F.log1p("revenue_usd").alias("log_revenue"),
        *flag,
    )


def audit_checks(
    clean_a: DataFrame,
    clean_b: DataFrame,
    matches: DataFrame,
    master: DataFrame,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """28 checks as ``(check, status, detail)``; one aggregate per table, joined as scalars.

    ``matches`` holds the fused pairs only.
    """
    a, b = settings.source_a, settings.source_b
    kinds = ["merged", f"{a}_only", f"{b}_only"]
    rows = F.count(F.lit(1))
    score = F.col("data_quality_score")
    original = [
        c.eqNullSafe(F.col("title_display"))
        for c in (F.col(f"title_display_{a}"), F.col(f"title_display_{b}"))
    ]
    untouched = (F.col("record_type") != "merged") | original[0] | original[1]

    def has(df: DataFrame, *columns: str) -> Column:
        return F.lit(all(c in df.columns for c in columns))

    def no_imputation(field: str) -> Column:
        # a value exists exactly where the source observed one
        return F.every(F.col(f"{field}_usd").isNotNull() == F.col(f"{field}_observed"))

    facts = master.agg(
        rows.alias("n_master"),
        F.count_if(~F.col("record_type").isin(kinds)).alias("other_kinds"),
        F.count_distinct("record_type").alias("n_kinds"),
        F.every((score >= 0) & (score <= 1)).alias("score_ok"),
        F.every(F.col("source_count").isNotNull()).alias("count_ok"),
        no_imputation("budget").alias("budget_ok"),
        no_imputation("revenue").alias("revenue_ok"),
        F.every(untouched).alias("titles_ok"),
    ).withColumns({
        "n_a": clean_a.agg(rows).scalar(),
        "n_b": clean_b.agg(rows).scalar(),
        "n_matches": matches.agg(rows).scalar(),
        "only_strong": matches.agg(F.every(F.col("match_status") == "strong_match")).scalar(),
        "dup_a": count_duplicates(clean_a, [f"{a}_id"]).select("n_duplicates").scalar(),
        "dup_b": count_duplicates(clean_b, ["title_norm", "release_year"]).select("n_duplicates").scalar(),
    })
    c = F.col
    none = F.lit("")

    def text(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    checks: list[tuple[str, Column, Column]] = [
        ("two_sources_loaded", (c("n_a") > 0) & (c("n_b") > 0), text("a=", c("n_a"), ", b=", c("n_b"))),
        ("dedup_a", c("dup_a") == 0, text("duplicates=", c("dup_a"))),
        ("dedup_b", c("dup_b") == 0, text("duplicates=", c("dup_b"))),
        ("title_norm_present", has(master, "title_norm"), none),
        ("linkage_ran", c("n_matches") > 0, text("strong=", c("n_matches"))),
        ("linkage_score_column", has(matches, "linkage_score"), none),
        ("linkage_status_column", has(matches, "match_status") | has(master, "linkage_status"), none),
        ("match_method_column", has(matches, "match_method"), none),
        ("golden_record_created", c("n_master") > 0, text("rows=", c("n_master"))),
        ("record_type_three_values", (c("other_kinds") == 0) & (c("n_kinds") == 3), none),
        (
            "row_identity",
            c("n_master") == c("n_a") + c("n_b") - c("n_matches"),
            text(c("n_master"), " = ", c("n_a"), " + ", c("n_b"), " - ", c("n_matches")),
        ),
        ("source_trace_column", has(master, "source_trace"), none),
        ("source_count_column", has(master, "source_count"), none),
        ("data_quality_score_present", has(master, "data_quality_score"), none),
        ("data_quality_score_range", c("score_ok"), none),
        ("completeness_present", has(master, "completeness_score"), none),
        ("validity_present", has(master, "validity_score"), none),
        ("consistency_present", has(master, "consistency_score"), none),
        ("outliers_flagged_not_removed", has(master, "any_outlier_flag"), none),
        ("multivariate_flag_present", has(master, "multivariate_outlier_iso"), none),
        ("budget_not_imputed", c("budget_ok"), none),
        ("revenue_not_imputed", c("revenue_ok"), none),
        ("genres_canonical_present", has(master, "genres_canonical"), none),
        ("rating_normalized_present", has(master, "rating_normalized"), none),
        ("only_strong_fused", F.coalesce(c("only_strong"), F.lit(True)), none),
        ("source_count_complete", c("count_ok"), none),
        ("titles_not_imputed", c("titles_ok"), none),
        (
            "conflict_flags_present",
            has(master, "runtime_conflict", "rating_conflict", "year_conflict", "genre_conflict"),
            none,
        ),
    ]
    packed = F.explode(F.array(*[
        F.struct(
            F.lit(name).alias("check"),
            F.when(ok, "PASS").otherwise("FAIL").alias("status"),
            detail.alias("detail"),
        )
        for name, ok, detail in checks
    ]))
    return facts.select(packed.alias("c")).select("c.*")


NULL_REPORT_COLUMNS: Sequence[str] = (
    "tmdb_id", "imdb_path", "budget_usd", "revenue_usd", "popularity_tmdb", "vote_average_tmdb",
    "rating_imdb", "director", "cast", "overview", "production_companies",
)
