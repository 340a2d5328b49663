"""Cleaning of the two catalogues: one projection and one window each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fusework.config import DEFAULTS, UNKNOWN, Settings
from fusework.functions import parse as P, text as X
from fusework.functions.lists import join_list, parse_list_field
from fusework.operators.dedup import dedup_best_record, dedup_by_key


def optional(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """A column that a source may lack."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def observed_flags(prefix: str, money: Column) -> list[Column]:
    """Value, was_zero, parse_status, missing and observed columns of a parsed money field."""
    value = money["value"]
    return [
        value.alias(f"{prefix}_usd"),
        money["was_zero"].alias(f"{prefix}_was_zero"),
        money["status"].alias(f"{prefix}_parse_status"),
        value.isNull().alias(f"{prefix}_missing"),
        value.isNotNull().alias(f"{prefix}_observed"),
    ]


def _genres_missing(name: str) -> Column:
    return (F.col(name) == F.array(F.lit(UNKNOWN))).alias("genres_missing")


def clean_catalog_a(raw: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Source A, one row per id. ``row_id`` must be unique.

    Parsers run in a first projection, their fields are taken in a second: Spark keeps the two
    apart, so no text is parsed twice.
    """
    a = settings.source_a
    one = dedup_by_key(raw, "id", "row_id")
    parsed = one.select(
        F.col("row_id").alias("a_row_id"),
        F.col("id").cast("string").alias(f"{a}_id"),
        X.strip(F.col("title")).alias("title"),
        X.normalize_title(F.col("title")).alias("title_norm"),
        P.parse_date(F.col("release_date").cast("string")).alias("release_date"),
        F.col("runtime").cast("string").alias("runtime_raw"),
        P.numeric_coerce(F.col("runtime")).alias("runtime"),
        P.parse_money(F.col("budget").cast("string")).alias("budget"),
        P.parse_money(F.col("revenue").cast("string")).alias("revenue"),
        P.numeric_coerce(F.col("vote_average")).alias("rating"),
        P.numeric_coerce(F.col("vote_count")).alias("votes"),
        P.numeric_coerce(F.col("popularity")).alias("popularity"),
        X.normalize_genres(parse_list_field(F.col("genre_names"))).alias("genres"),
        join_list(parse_list_field(optional(one, "production_company_names"))).alias("production_companies"),
        join_list(parse_list_field(optional(one, "origin_country"))).alias("origin_country_clean"),
        X.clean_code(optional(one, "original_language")).alias("original_language_clean"),
        optional(one, "adult").alias("adult"),
    )
    year = F.year("release_date")
    runtime = P.runtime_range_guard(F.col("runtime"), settings)
    votes = P.zero_vote_guard(F.col("rating"), F.col("votes"), settings)
    return parsed.select(
        "a_row_id",
        f"{a}_id",
        F.col("title").alias(f"title_display_{a}"),
        "title_norm",
        F.col("title_norm").isNull().alias("title_missing"),
        "release_date",
        year.alias("release_year"),
        P.decade(year).alias("release_decade"),
        year.isNull().alias("year_missing"),
        P.year_out_of_range(year, settings).alias("year_out_of_range"),
        "runtime_raw",
        runtime["minutes"].alias("runtime_min"),
        runtime["was_zero"].alias("runtime_was_zero"),
        runtime["out_of_range"].alias("runtime_out_of_range"),
        runtime["missing"].alias("runtime_missing"),
        *observed_flags("budget", F.col("budget")),
        *observed_flags("revenue", F.col("revenue")),
        F.col("rating").alias(f"vote_average_{a}_raw"),
        F.col("votes").alias(f"vote_count_{a}"),
        votes["votes_zero"].alias("vote_count_zero"),
        votes["rating_zero"].alias("vote_average_zero"),
        votes["rating"].alias(f"vote_average_{a}"),
        votes["rating"].isNull().alias("rating_missing"),
        F.col("popularity").alias(f"popularity_{a}"),
        F.coalesce(F.col("popularity") == 0, F.lit(False)).alias("popularity_zero"),
        F.col("genres").alias(f"genres_list_{a}"),
        _genres_missing("genres"),
        "production_companies",
        "origin_country_clean",
        "original_language_clean",
        "adult",
    )


def clean_catalog_b(raw: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Source B, the best row per title and year. ``row_id`` must be unique."""
    b = settings.source_b
    parsed = raw.select(
        F.col("row_id").alias("b_row_id"),
        X.strip(F.col("path")).alias(f"{b}_path"),
        X.strip(F.col("movie_title")).alias("title"),
        X.normalize_title(F.col("movie_title")).alias("title_norm"),
        P.numeric_coerce(F.col("year")).alias("year_raw"),
        P.parse_runtime(F.col("run_time").cast("string"), settings).alias("runtime"),
        P.numeric_coerce(F.col("rating")).alias("rating"),
        P.parse_count_suffix(F.col("user_rating").cast("string")).alias("votes"),
        X.normalize_genres(parse_list_field(F.col("generes"))).alias("genres"),
        *[X.fill_blank_text(F.col(c)).alias(c) for c in ("overview", "director", "writer")],
        X.fill_blank_text(F.col("plot_kyeword")).alias("keywords"),
        X.fill_blank_text(F.col("top_5_casts")).alias("cast"),
    )
    repaired = P.repair_negative_year(F.col("year_raw"))
    year = repaired["year"]
    rating = P.rating_range_guard(F.col("rating"), settings)
    cleaned = parsed.select(
        "b_row_id",
        f"{b}_path",
        F.col("title").alias(f"title_display_{b}"),
        "title_norm",
        F.col("title_norm").isNull().alias("title_missing"),
        "year_raw",
        repaired["was_negative"].alias("year_was_negative"),
        year.alias("release_year"),
        year.isNull().alias("year_missing"),
        P.year_out_of_range(year, settings).alias("year_out_of_range"),
        P.first_day_of_year(year).alias("release_date"),
        P.decade(year).alias("release_decade"),
        F.col("runtime.minutes").alias("runtime_min"),
        F.col("runtime.status").alias("runtime_parse_status"),
        F.col("runtime.minutes").isNull().alias("runtime_missing"),
        rating.alias(f"rating_{b}"),
        rating.isNull().alias("rating_missing"),
        F.col("votes").alias(f"user_rating_count_{b}"),
        F.col("genres").alias(f"genres_list_{b}"),
        _genres_missing("genres"),
        "overview",
        "director",
        "writer",
        "keywords",
        "cast",
    )
    evidence = [F.col(f"rating_{b}").isNotNull(), F.col("runtime_min").isNotNull(), F.col("overview") != ""]
    return dedup_best_record(cleaned, ["title_norm", "release_year"], evidence, "b_row_id")


def cleaning_summary(
    raw_a: DataFrame, raw_b: DataFrame, clean_a: DataFrame, clean_b: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Raw against clean, one row per source."""
    flags = ["title_missing", "year_missing", "runtime_missing", "rating_missing", "genres_missing"]

    def side(label: str, raw: DataFrame, clean: DataFrame) -> DataFrame:
        total = raw.agg(F.count(F.lit(1))).scalar()
        counts = clean.agg(
            F.count(F.lit(1)).alias("rows_clean"),
            *[F.count_if(F.col(f)).alias(f) for f in flags],
        )
        return counts.select(
            F.lit(label).alias("source"),
            total.alias("rows_raw"),
            "rows_clean",
            (total - F.col("rows_clean")).alias("rows_removed"),
            *flags,
        )

    return side(settings.source_a, raw_a, clean_a).unionByName(side(settings.source_b, raw_b, clean_b))
