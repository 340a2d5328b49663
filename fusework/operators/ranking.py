"""Min-max scaling, the two rankings and the table of conclusions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fusework.config import UNKNOWN
from fusework.operators.quantiles import exact_quantiles

# Weights of the genre score; the last one counts against a genre.
GENRE_WEIGHTS = {
    "profitable_pct": 0.30,
    "revenue_median": 0.20,
    "popularity_mean": 0.15,
    "rating_mean": 0.10,
    "recent_pct": 0.10,
    "budget_coverage": 0.05,
    "dqs_mean": 0.05,
    "outlier_pct": -0.05,
}

# Weights of the marketing score.
MARKETING_WEIGHTS = {
    "log_revenue": 0.40,
    "rating_normalized": 0.30,
    "popularity_tmdb": 0.20,
    "data_quality_score": 0.10,
}


def minmax_scale(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """(x - min) / (max - min), 0.5 for a constant column. The extremes are one aggregate."""
    edges = df.agg(
        F.struct(*[x for c in columns for x in (F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi"))])
    ).scalar()

    def scaled(c: str) -> Column:
        low, high = F.col(f"__edges.{c}_lo"), F.col(f"__edges.{c}_hi")
        value = F.when(high > low, (F.col(c) - low) / (high - low)).otherwise(0.5)
        return F.when(F.col(c).isNotNull(), value).alias(f"{c}{suffix}")

    return df.withColumn("__edges", edges).select(*df.columns, *[scaled(c) for c in columns])


def _weighted(weights: dict[str, float]) -> Column:
    return sum(F.lit(w) * F.col(f"{c}_scaled") for c, w in weights.items())


def genre_statistics(master: DataFrame, recent_from: int = 2015) -> DataFrame:
    exploded = master.select(
        F.explode("genres_list").alias("genre"), "title_display", "is_profitable", "revenue_usd",
        "popularity_tmdb", "rating_normalized", "data_quality_score", "release_year", "budget_usd",
        "any_outlier_flag",
    ).where(F.col("genre") != UNKNOWN)
    recent = F.coalesce(F.col("release_year") >= recent_from, F.lit(False))
    basic = exploded.groupBy("genre").agg(
        F.count("title_display").alias("n_movies"),
        F.avg("is_profitable").alias("profitable_pct"),
        F.avg("revenue_usd").alias("revenue_mean"),
        F.avg("popularity_tmdb").alias("popularity_mean"),
        F.avg("rating_normalized").alias("rating_mean"),
        F.avg("data_quality_score").alias("dqs_mean"),
        F.avg(recent.cast("int")).alias("recent_pct"),
        F.avg(F.col("budget_usd").isNotNull().cast("int")).alias("budget_coverage"),
        F.avg(F.col("any_outlier_flag").cast("int")).alias("outlier_pct"),
    )
    medians = exact_quantiles(exploded, "revenue_usd", {"revenue_median": 0.5}, ["genre"]).drop("__n")
    return basic.join(medians, "genre", "left")


def genre_investment_ranking(master: DataFrame, min_movies: int = 30, recent_from: int = 2015) -> DataFrame:
    stats = genre_statistics(master, recent_from).where(F.col("n_movies") >= min_movies)
    filled = stats.select("genre", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in GENRE_WEIGHTS])
    scores = minmax_scale(filled, list(GENRE_WEIGHTS)).select(
        "genre", F.round(_weighted(GENRE_WEIGHTS), 4).alias("strategic_investment_score")
    )
    return stats.join(scores, "genre").orderBy(F.desc("strategic_investment_score"), "genre")


def marketing_priority_ranking(master: DataFrame, n: int = 50) -> DataFrame:
    """Conflict-free records by commercial potential, rating, popularity and data quality."""
    conflict = F.greatest(*[
        F.coalesce(c, F.lit(False))
        for c in ("runtime_conflict", "rating_conflict", "year_conflict", "genre_conflict")
    ])
    rows = master.where(
        ~conflict
        & F.col("revenue_usd").isNotNull()
        & F.col("rating_normalized").isNotNull()
        & F.col("popularity_tmdb").isNotNull()
    ).select(
        "movie_master_id", "title_display", "release_year", "revenue_usd", "rating_normalized",
        "popularity_tmdb", "genres_canonical",
        F.log1p("revenue_usd").alias("log_revenue"),
        F.coalesce("data_quality_score", F.lit(0.0)).alias("data_quality_score"),
    )
    scored = minmax_scale(rows, list(MARKETING_WEIGHTS)).withColumn(
        "marketing_priority_score", F.round(_weighted(MARKETING_WEIGHTS), 4)
    )
    return scored.orderBy(F.desc("marketing_priority_score"), "movie_master_id").limit(n).select(
        "movie_master_id", "title_display", "release_year", "revenue_usd", "rating_normalized",
        "popularity_tmdb", "genres_canonical", "marketing_priority_score",
    )


def conclusions_facts(
    master: DataFrame,
    genre_ranking: DataFrame | None = None,
    marketing_ranking: DataFrame | None = None,
    profit_models: DataFrame | None = None,
    revenue_models: DataFrame | None = None,
) -> DataFrame:
    """``(type, metric, value)``: the facts behind the conclusions, values as text."""
    kind = F.col("record_type")
    one = master.agg(
        F.count(F.lit(1)).cast("string").alias("n_master"),
        F.count_if(kind == "merged").cast("string").alias("n_merged"),
        F.count_if(kind == "tmdb_only").cast("string").alias("n_tmdb_only"),
        F.count_if(kind == "imdb_only").cast("string").alias("n_imdb_only"),
        F.format_number(F.avg("data_quality_score"), 4).alias("dqs_mean"),
        F.count_if("any_outlier_flag").cast("string").alias("n_outliers"),
    )
    facts = one.unpivot([], one.columns, "metric", "value").select(F.lit("technical").alias("type"), "metric", "value")

    def best(df: DataFrame, type_: str, metric: str, label: str, score: str) -> DataFrame:
        first = df.orderBy(F.desc(score), label).limit(1)
        return first.select(
            F.explode(F.array(
                F.struct(F.lit(metric).alias("metric"), F.col(label).cast("string").alias("value")),
                F.struct(
                    F.lit(f"{metric}_score").alias("metric"), F.format_number(score, 4).alias("value")
                ),
            )).alias("f")
        ).select(F.lit(type_).alias("type"), "f.metric", "f.value")

    for df, args in (
        (profit_models, ("model", "best_profit_model", "model", "roc_auc")),
        (revenue_models, ("model", "best_revenue_model", "model", "r2")),
        (genre_ranking, ("business", "best_genre", "genre", "strategic_investment_score")),
        (marketing_ranking, ("business", "best_marketing", "title_display", "marketing_priority_score")),
    ):
        if df is not None:
            facts = facts.unionByName(best(df, *args))
    return facts
