"""The twenty fixed reports over the master table.

A reports look at records with source A, B reports at records with source B, M reports at merged
records. Every top-k has a unique last sort key, so ties never depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fusework.config import DEFAULTS, DIRECTOR_NOISE, UNKNOWN, Settings
from fusework.functions.numbers import percent, percent_true
from fusework.operators.quantiles import mean_median_count

ID = "movie_master_id"


def subset_a(master: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return master.where(F.col("record_type").isin("merged", f"{settings.source_a}_only"))


def subset_b(master: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return master.where(F.col("record_type").isin("merged", f"{settings.source_b}_only"))


def subset_merged(master: DataFrame) -> DataFrame:
    return master.where(F.col("record_type") == "merged")


def _top(df: DataFrame, order: list[Column], n: int, columns: list[str]) -> DataFrame:
    return df.orderBy(*order, F.col(ID).asc()).limit(n).select(ID, *columns)


def _known_director() -> Column:
    return F.col("director").isNotNull() & ~F.trim("director").isin(*DIRECTOR_NOISE)


def _genres(df: DataFrame, *keep: str) -> DataFrame:
    exploded = df.select(F.explode("genres_list").alias("genre"), *keep)
    return exploded.where(F.col("genre") != UNKNOWN)


# --- source A ----------------------------------------------------------------------------------


def a_q1_top_revenue(master: DataFrame, n: int = 10) -> DataFrame:
    rows = subset_a(master).where(F.col("revenue_usd").isNotNull())
    return _top(rows, [F.desc("revenue_usd")], n, [
        "title_display", "release_year", "budget_usd", "revenue_usd", "profit_usd", "roi",
        "rating_normalized", "popularity_tmdb", "record_type",
    ])


def a_q2_financial_quality(master: DataFrame) -> DataFrame:
    flags = [
        "budget_was_zero", "revenue_was_zero", "budget_usd_outlier_iqr", "revenue_usd_outlier_iqr",
        "roi_outlier_iqr", "multivariate_outlier_iso",
    ]
    exprs = {
        "budget_missing": F.count_if(F.col("budget_usd").isNull()),
        "revenue_missing": F.count_if(F.col("revenue_usd").isNull()),
    } | {f: F.count_if(F.col(f)) for f in flags if f in master.columns}
    one = subset_a(master).agg(F.count(F.lit(1)).alias("__rows"), *[e.alias(n) for n, e in exprs.items()])
    return one.unpivot(["__rows"], list(exprs), "metric", "count").select(
        "metric", "count", percent(F.col("count"), F.col("__rows")).alias("pct")
    )


def a_q3_genre_frequency(master: DataFrame, n: int = 15) -> DataFrame:
    """The n most frequent genres; "Unknown" is dropped after the cut."""
    counts = (
        subset_a(master).select(F.explode("genres_list").alias("genre"))
        .groupBy("genre").agg(F.count(F.lit(1)).alias("count"))
    )
    return counts.orderBy(F.desc("count"), "genre").limit(n).where(F.col("genre") != UNKNOWN)


def a_q4_popularity_by_decade(master: DataFrame) -> DataFrame:
    stats = mean_median_count(
        subset_a(master), "release_decade", "popularity_tmdb", "popularity_mean", "popularity_median", "n_movies"
    )
    return stats.select(
        "release_decade",
        F.round("popularity_mean", 4).alias("popularity_mean"),
        F.round("popularity_median", 4).alias("popularity_median"),
        "n_movies",
    ).orderBy("release_decade")


def a_q5_top_outliers(master: DataFrame, n: int = 25) -> DataFrame:
    flags = [
        f for f in (
            "budget_usd_outlier_iqr", "revenue_usd_outlier_iqr", "roi_outlier_iqr", "multivariate_outlier_iso"
        ) if f in master.columns
    ]
    n_flags = sum((F.col(f).cast("int") for f in flags), F.lit(0))
    rows = subset_a(master).where(F.col("revenue_usd").isNotNull()).withColumn("n_flags", n_flags)
    return _top(rows, [F.desc("n_flags"), F.desc("revenue_usd")], n, [
        "title_display", "release_year", "budget_usd", "revenue_usd", "roi", "rating_normalized", "n_flags",
    ])


# --- source B ----------------------------------------------------------------------------------


def b_q1_top_rating(master: DataFrame, n: int = 10) -> DataFrame:
    rows = subset_b(master).where(F.col("rating_imdb").isNotNull())
    return _top(rows, [F.desc("rating_imdb")], n, [
        "title_display", "release_year", "rating_imdb", "user_rating_count_imdb", "director", "record_type",
    ])


def b_q2_top_directors(master: DataFrame, n: int = 15) -> DataFrame:
    counts = subset_b(master).where(_known_director()).groupBy("director").agg(
        F.count(F.lit(1)).alias("n_movies")
    )
    return counts.orderBy(F.desc("n_movies"), "director").limit(n)


def b_q3_runtime_by_genre(master: DataFrame, min_movies: int = 20) -> DataFrame:
    rows = _genres(subset_b(master).where(F.col("runtime_min").isNotNull()), "runtime_min")
    stats = mean_median_count(rows, "genre", "runtime_min", "runtime_mean", "runtime_median", "n_movies")
    return stats.where(F.col("n_movies") >= min_movies).select(
        "genre",
        F.round("runtime_mean", 2).alias("runtime_mean"),
        F.round("runtime_median", 2).alias("runtime_median"),
        "n_movies",
    ).orderBy(F.desc("runtime_mean"), "genre")


def b_q4_missing_fields(master: DataFrame) -> DataFrame:
    fields = [
        f for f in ("director", "cast", "overview", "rating_imdb", "runtime_min", "keywords") if f in master.columns
    ]
    types = dict(master.dtypes)

    def missing(f: str) -> Column:
        c = F.col(f)
        blank = c.isNull() | (F.trim(c) == "") if types[f] == "string" else c.isNull()
        return F.count_if(blank).alias(f)

    one = subset_b(master).agg(F.count(F.lit(1)).alias("__rows"), *[missing(f) for f in fields])
    return one.unpivot(["__rows"], fields, "field", "n_null").select(
        "field", "n_null", percent(F.col("n_null"), F.col("__rows")).alias("pct_null")
    ).orderBy(F.desc("pct_null"), "field")


def b_q5_rating_by_decade(master: DataFrame) -> DataFrame:
    stats = mean_median_count(
        subset_b(master), "release_decade", "rating_imdb", "rating_mean", "rating_median", "n_movies"
    )
    return stats.select(
        "release_decade", F.round("rating_mean", 2).alias("rating_mean"), "rating_median", "n_movies"
    ).orderBy("release_decade")


# --- merged ------------------------------------------------------------------------------------


def m_q1_top_linkage(master: DataFrame, n: int = 20) -> DataFrame:
    rows = subset_merged(master).where(F.col("linkage_score").isNotNull())
    return _top(rows, [F.desc("linkage_score")], n, [
        "title_display", "release_year", "linkage_score", "match_method", "vote_average_tmdb",
        "rating_imdb", "rating_normalized",
    ])


def _different_titles(master: DataFrame) -> DataFrame:
    a, b = (F.lower(F.trim(f"title_display_{s}")) for s in ("tmdb", "imdb"))
    return subset_merged(master).where(a != b)


def m_q2_title_differences(master: DataFrame, n: int = 30) -> DataFrame:
    return _top(_different_titles(master), [], n, [
        "title_display_tmdb", "title_display_imdb", "release_year", "linkage_score", "match_method",
    ])


def m_q2_by_method(master: DataFrame) -> DataFrame:
    return _different_titles(master).groupBy("match_method").agg(F.count(F.lit(1)).alias("count"))


def m_q3_rating_disagreement(master: DataFrame, n: int = 25) -> DataFrame:
    gap = F.abs(F.col("vote_average_tmdb") - F.col("rating_imdb"))
    rows = subset_merged(master).withColumn("rating_diff", gap).where(F.col("rating_diff").isNotNull())
    return _top(rows, [F.desc("rating_diff")], n, [
        "title_display", "release_year", "vote_average_tmdb", "vote_count_tmdb", "rating_imdb",
        "user_rating_count_imdb", "rating_diff",
    ])


def m_q4_runtime_conflicts(master: DataFrame, n: int = 25) -> DataFrame:
    gap = F.abs(F.col("runtime_tmdb") - F.col("runtime_imdb"))
    rows = subset_merged(master).withColumn("runtime_diff", gap).where(F.col("runtime_diff").isNotNull())
    return _top(rows, [F.desc("runtime_diff")], n, [
        "title_display", "release_year", "runtime_tmdb", "runtime_imdb", "runtime_diff",
    ])


def m_q5_high_rating_low_revenue(
    master: DataFrame, min_rating: float = 8.4, max_revenue: float = 2_500_000, n: int = 25
) -> DataFrame:
    rows = subset_merged(master).where(
        (F.col("rating_imdb") >= min_rating) & (F.col("revenue_usd") < max_revenue)
    )
    return _top(rows, [F.desc("rating_imdb")], n, [
        "title_display", "release_year", "rating_imdb", "revenue_usd", "budget_usd", "roi", "director",
    ])


def m_q6_high_revenue_low_rating(
    master: DataFrame, max_rating: float = 5.5, min_revenue: float = 200_000_000, n: int = 25
) -> DataFrame:
    rows = subset_merged(master).where(
        (F.col("rating_imdb") < max_rating) & (F.col("revenue_usd") > min_revenue)
    )
    return _top(rows, [F.desc("revenue_usd")], n, [
        "title_display", "release_year", "revenue_usd", "rating_imdb", "vote_average_tmdb", "roi",
    ])


def m_q7_director_revenue(master: DataFrame, min_movies: int = 3, n: int = 20) -> DataFrame:
    rows = subset_merged(master).where(_known_director() & F.col("revenue_usd").isNotNull())
    stats = rows.groupBy("director").agg(
        F.count("revenue_usd").alias("n_movies"),
        F.round(F.avg("revenue_usd"), 0).alias("revenue_mean"),
        F.sum("revenue_usd").alias("revenue_total"),
        F.round(F.avg("roi"), 2).alias("roi_mean"),
        F.round(F.avg("rating_imdb"), 2).alias("rating_mean"),
    )
    return stats.where(F.col("n_movies") >= min_movies).orderBy(F.desc("revenue_mean"), "director").limit(n)


def m_q8_genre_roi(master: DataFrame, min_movies: int = 20) -> DataFrame:
    rows = _genres(subset_merged(master).where(F.col("roi").isNotNull()), "roi")
    stats = mean_median_count(rows, "genre", "roi", "roi_mean", "roi_median", "n_movies")
    return stats.where(F.col("n_movies") >= min_movies).select(
        "genre", F.round("roi_median", 2).alias("roi_median"), F.round("roi_mean", 2).alias("roi_mean"), "n_movies"
    ).orderBy(F.desc("roi_median"), "genre")


def m_q9_decade_profitability(master: DataFrame) -> DataFrame:
    rows = subset_merged(master).where(F.col("is_profitable").isNotNull() & F.col("release_decade").isNotNull())
    return rows.groupBy("release_decade").agg(
        percent_true(F.col("is_profitable") == 1, 2).alias("profitable_pct"),
        F.count("is_profitable").alias("n_movies"),
    ).orderBy("release_decade")


def m_q10_high_potential(master: DataFrame, min_rating: float = 7.5, n: int = 25) -> DataFrame:
    conflicts = [F.coalesce(c, F.lit(False)) for c in (
        "runtime_conflict", "rating_conflict", "year_conflict", "genre_conflict")]
    score = F.log1p("revenue_usd") * F.col("rating_imdb") / 10.0
    rows = subset_merged(master).where(
        ~F.greatest(*conflicts) & F.col("revenue_usd").isNotNull() & (F.col("rating_imdb") >= min_rating)
    ).withColumn("commercial_potential_score", score)
    return _top(rows, [F.desc("commercial_potential_score")], n, [
        "title_display", "release_year", "revenue_usd", "rating_imdb", "rating_normalized",
        "commercial_potential_score",
    ])


A_REPORTS = {f.__name__: f for f in (
    a_q1_top_revenue, a_q2_financial_quality, a_q3_genre_frequency, a_q4_popularity_by_decade, a_q5_top_outliers,
)}
B_REPORTS = {f.__name__: f for f in (
    b_q1_top_rating, b_q2_top_directors, b_q3_runtime_by_genre, b_q4_missing_fields, b_q5_rating_by_decade,
)}
M_REPORTS = {f.__name__: f for f in (
    m_q1_top_linkage, m_q2_title_differences, m_q3_rating_disagreement, m_q4_runtime_conflicts,
    m_q5_high_rating_low_revenue, m_q6_high_revenue_low_rating, m_q7_director_revenue, m_q8_genre_roi,
    m_q9_decade_profitability, m_q10_high_potential,
)}
REPORTS = A_REPORTS | B_REPORTS | M_REPORTS
