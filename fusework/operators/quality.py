"""Per-record data quality score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fusework.config import DEFAULTS, Settings
from fusework.functions import parse as P


def quality_scores(master: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Completeness, validity, consistency, uniqueness, traceability and their weighted sum."""

    def share(conditions: list[Column]) -> Column:
        return sum(c.cast("int") for c in conditions) / len(conditions)

    completeness = share(
        [~P.is_missing_text(F.col(c)) for c in ("title_display", "genres_canonical")]
        + [
            F.col(c).isNotNull()
            for c in ("release_year", "runtime_min", "rating_normalized", "budget_usd", "revenue_usd")
        ]
    )
    validity = share([
        ~P.safe_bool(F.col(c))
        for c in ("title_missing", "year_out_of_range", "runtime_out_of_range", "rating_missing", "genres_missing")
    ])
    consistency = share([
        ~P.safe_bool(F.col(c))
        for c in ("runtime_conflict", "rating_conflict", "genre_conflict", "year_conflict")
    ])
    uniqueness = F.lit(1.0)  # deduplication and one-to-one matches guarantee it
    traceability = F.when(F.col("source_count") >= 1, 1.0).otherwise(0.0)
    total = (
        settings.dqs_completeness * completeness
        + settings.dqs_validity * validity
        + settings.dqs_consistency * consistency
        + settings.dqs_uniqueness * uniqueness
        + settings.dqs_traceability * traceability
    )
    return master.select(
        "*",
        F.round(completeness, 4).alias("completeness_score"),
        F.round(validity, 4).alias("validity_score"),
        F.round(consistency, 4).alias("consistency_score"),
        uniqueness.alias("uniqueness_score"),
        traceability.alias("traceability_score"),
        F.round(total, 4).alias("data_quality_score"),
    )
