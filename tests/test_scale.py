"""Work per task: how many tasks share a step, and how much they hand on."""

from __future__ import annotations

from pyspark.sql import functions as F

from fusework.functions.text import normalize_genres
from fusework.operators import recommend
from fusework.sources import fixtures


def _part(spark, folder):
    rows = spark.range(200).select(
        F.col("id").alias("p_partkey"), F.lit("hot bolt").alias("p_name"), F.lit("Brand#7").alias("p_brand"),
        F.lit("LARGE").alias("p_type"), F.lit(3).alias("p_size"), F.lit(1.0).alias("p_retailprice"),
    )
    rows.coalesce(1).write.parquet(f"{folder}/part.parquet")


def test_catalogues_of_one_split_are_parsed_by_all_cores(spark, tmp_path):
    _part(spark, tmp_path)
    cores = spark.sparkContext.defaultParallelism
    for catalogue, n in ((fixtures.cat_a, 200), (fixtures.cat_b, 55)):
        rows = catalogue(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() >= cores
        assert rows.count() == n


def test_genres_are_normalized_once(spark):
    genres = normalize_genres(F.col("g"))
    df = spark.createDataFrame([(["rom-com", "Romance", " "],), ([],), (None,)], "g array<string>").select(genres.alias("g"))
    assert [r.g for r in df.collect()] == [["Romance"], ["Unknown"], ["Unknown"]]
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("array_distinct(") == 1


def test_tfidf_buckets_equal_the_long_form_and_shuffle_no_term_of_a_text(spark, monkeypatch):
    texts = ["The old man and the sea", "the old old man", "ÄRA sea_9 and the", None, "", "x", "the old man"]
    rows = [(i, t) for i, t in enumerate(texts * 9)] + [(3, "the sea and the old"), (None, "old man"), (None, "sea man")]
    df = spark.createDataFrame(rows, "key bigint, text string").repartition(5)
    counts = recommend.term_counts(df, "key", "text")
    n = df.count()
    kept = counts.join(recommend.vocabulary(counts), "term").selectExpr("key", "term", f"tf * (ln({1 + n} / (1 + df)) + 1) AS w").collect()
    length = {}
    for r in kept:
        length[r.key] = length.get(r.key, 0.0) + r.w**2
    expected = {(r.key, r.term): round(r.w / length[r.key] ** 0.5, 9) for r in kept}
    for chars in (100, 8_000_000):
        monkeypatch.setattr(recommend, "BUCKET_CHARS", chars)
        found = recommend.tfidf_features(df, "key", "text")
        got = found.collect()
        assert {(r.key, r.term): round(r.weight, 9) for r in got} == expected and len(got) == len(expected)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "hashpartitioning(key" not in plan
    assert recommend.tfidf_features(df.where("false"), "key", "text").count() == 0
