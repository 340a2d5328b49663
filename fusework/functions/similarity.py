"""Pair similarities, the composite linkage score and the conflict rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fusework.config import DEFAULTS, Settings


def runtime_similarity(a: Column, b: Column) -> Column:
    gap = F.abs(a - b)
    return (
        F.when(gap <= 5, F.lit(100.0))
        .when(gap >= 60, F.lit(0.0))
        .when(gap.isNotNull(), 100.0 * (1.0 - gap / 60.0))
    )


def year_similarity(a: Column, b: Column) -> Column:
    gap = F.abs(a - b)
    return (
        F.when(gap == 0, F.lit(100.0))
        .when(gap == 1, F.lit(70.0))
        .when(gap == 2, F.lit(30.0))
        .when(gap.isNotNull(), F.lit(0.0))
    )


def genre_set(genres: Column) -> Column:
    """Sorted lower-cased genres without "unknown": what genre comparisons look at."""
    lowered = F.transform(
        F.coalesce(genres, F.array().cast("array<string>")), lambda g: F.lower(F.trim(g))
    )
    known = F.filter(lowered, lambda g: g.isNotNull() & ~g.isin("", "unknown"))
    return F.array_sort(F.array_distinct(known))


def genre_set_similarity(a: Column, b: Column) -> Column:
    """100 times Jaccard of two genre sets, NULL when either is empty."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), 100.0 * shared / total)


def genre_similarity(a: Column, b: Column) -> Column:
    return genre_set_similarity(genre_set(a), genre_set(b))


def composite_linkage_score(
    title: Column, year: Column, runtime: Column, genre: Column, settings: Settings = DEFAULTS
) -> Column:
    """Weighted mean over the signals that are present."""
    parts = [
        (settings.weight_title, title),
        (settings.weight_year, year),
        (settings.weight_runtime, runtime),
        (settings.weight_genre, genre),
    ]
    total = sum(F.when(v.isNotNull(), F.lit(w)).otherwise(0.0) for w, v in parts)
    value = sum(F.coalesce(F.lit(w) * v, F.lit(0.0)) for w, v in parts)
    return F.when(total > 0, value / total)


def classify_match(score: Column, settings: Settings = DEFAULTS) -> Column:
    return (
        F.when(score >= settings.score_strong, "strong_match")
        .when(score >= settings.score_probable, "probable_match")
        .when(score >= settings.score_manual, "manual_review")
        .otherwise("no_match")
    )


def gap_conflict(a: Column, b: Column, threshold: float) -> Column:
    """True when both values are there and further apart than the threshold."""
    return F.coalesce(F.abs(a - b) > threshold, F.lit(False))


def conflict_genre(a: Column, b: Column) -> Column:
    sa, sb = genre_set(a), genre_set(b)
    return (F.size(sa) > 0) & (F.size(sb) > 0) & (F.size(F.array_intersect(sa, sb)) == 0)
