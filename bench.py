"""Times the headline queries and prints one JSON line.

``build_master`` is the whole way from the raw catalogues to the flagged master table, with all three layers and the
isolation forest; the reports after it read stored tables, as they do in a run.
"""

from __future__ import annotations

import json
import os
import time

from fusework.session import local_session
from oracles.context import full_run
from oracles.registry import QUERIES

HEADLINE = (
    "clean_catalog_a", "clean_catalog_b", "normalize_basic_text", "dedup_by_key", "dedup_texts",
    "count_duplicates", "profile_columns", "top_value_counts_events", "match_exact", "match_year_pm1",
    "match_fuzzy_blocked", "golden_record", "assign_master_id", "exact_quantiles", "iqr_flags",
    "isolation_forest_lineitem", "audit_checks", "a_q1_top_revenue", "a_q4_popularity_by_decade",
    "m_q7_director_revenue", "m_q8_genre_roi", "genre_investment_ranking", "marketing_priority_ranking",
    "tfidf_features", "cosine_knn_documents", "cosine_knn", "minmax_scale",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.range(1).count()
    times: dict[str, float] = {}
    start = time.time()
    full_run(spark, sf_dir).master
    times["build_master"] = round(time.time() - start, 3)
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
