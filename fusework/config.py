"""All thresholds, weights and word lists in one place."""

from __future__ import annotations

from dataclasses import dataclass

# Canonical genre names.
GENRE_MAP = {
    "sci-fi": "Science Fiction",
    "sci fi": "Science Fiction",
    "science-fiction": "Science Fiction",
    "science fiction": "Science Fiction",
    "rom-com": "Romance",
    "romcom": "Romance",
    "biography": "Biographical",
    "action adventure": "Action",
    "tv movie": "TV Movie",
}

# Texts that stand for "no value" in a CSV cell (the pandas read_csv defaults).
CSV_NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Director texts that name nobody.
DIRECTOR_NOISE = ("See company contact information", "nan", "")

UNKNOWN = "Unknown"


@dataclass(frozen=True)
class Settings:
    """One configuration of the engine; the defaults describe the two film catalogues."""

    seed: int = 42

    # labels of the two sources, as they appear in record_type and source_trace
    source_a: str = "tmdb"
    source_b: str = "imdb"

    # valid ranges
    year_min: int = 1900
    year_max: int = 2026
    runtime_max: float = 600.0
    runtime_min_plausible: float = 20.0
    rating_max: float = 10.0

    # linkage score classes and weights
    score_strong: float = 90.0
    score_probable: float = 82.0
    score_manual: float = 75.0
    weight_title: float = 0.60
    weight_year: float = 0.25
    weight_runtime: float = 0.10
    weight_genre: float = 0.05
    fuzzy_candidates: int = 5

    # work units of the blocked comparison: no task holds more rows of a block than this
    block_rows_a: int = 10_000
    block_rows_b: int = 1_000
    block_chars: int = 1_000_000  # of titles, on either side

    # conflict thresholds
    conflict_runtime: float = 10.0
    conflict_rating: float = 2.0
    conflict_year: int = 1

    # data quality score weights
    dqs_completeness: float = 0.35
    dqs_validity: float = 0.25
    dqs_consistency: float = 0.20
    dqs_uniqueness: float = 0.10
    dqs_traceability: float = 0.10

    # outliers
    iqr_multiplier: float = 1.5
    iso_contamination: float = 0.03
    iso_trees: int = 100
    iso_sample: int = 256
    iso_min_rows: int = 100

    # models
    test_size: float = 0.25
    rf_trees: int = 100
    rf_depth: int = 30  # the deepest that Spark ML grows
    min_model_rows: int = 50

    # recommender
    tfidf_features: int | None = None  # None: every term found in enough texts
    tfidf_min_df: int = 2


DEFAULTS = Settings()
