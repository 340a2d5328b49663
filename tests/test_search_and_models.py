"""Neighbour searches, pruned scores, train-only medians and merged sketches against brute force."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fusework.functions.indel import TokenSetBlock
from fusework.operators import link, models, profile, recommend
from oracles import registry
from tests.test_functions import plain_token_set


def plain_neighbours(vectors, asked, n):
    """{query: [(key, similarity)]} of {key: vector}, ties to the smaller key."""
    lengths = {k: sum(x * x for x in v) ** 0.5 for k, v in vectors.items()}
    out = {}
    for q in asked:
        scores = [
            (-round(sum(x * y for x, y in zip(vectors[q], v)) / lengths[k] / lengths[q], 9), k) for k, v in vectors.items() if k != q
        ]
        out[q] = [(k, -s) for s, k in sorted(scores)[:n]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query"], -r["similarity"], r["key"])):
        out.setdefault(r["query"], []).append((r["key"], r["similarity"]))
    return out


@pytest.mark.parametrize("clusters", [20, 400])
def test_sparse_neighbours(spark, store, clusters):
    rng = random.Random(clusters)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    centres = [rng.choices(words, weights, k=40) for _ in range(clusters)]
    texts = {i: " ".join([*rng.sample(rng.choice(centres), 25), *rng.choices(words, weights, k=rng.randint(0, 25))]) for i in range(400)}
    texts[401], texts[402] = "lonely", ""
    df = spark.createDataFrame(list(texts.items()), "key bigint, text string")
    features = store.save(recommend.tfidf_features(df, "key", "text"), "features")
    rows = features.collect()
    terms = sorted({r.term for r in rows})
    place = {t: i for i, t in enumerate(terms)}
    vectors = {r.key: np.zeros(len(terms)) for r in rows}
    for r in rows:
        vectors[r.key][place[r.term]] = r.weight
    asked = [k for k in vectors if k % 10 == 0]
    keys = spark.createDataFrame([(k,) for k in [*asked, *asked, 402, 999]], "key bigint")
    got = found(recommend.sparse_knn(features, keys, 5, store.save))
    want = {q: [(k, s) for k, s in near if s > 0] for q, near in plain_neighbours(vectors, asked, 5).items()}
    assert got.keys() == {q for q in want if want[q]}
    for q in got:
        assert [k for k, _ in got[q]] == [k for k, _ in want[q]] and np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-8)
    # where a query has near texts, its rare terms settle it; texts like all others need all terms
    settled = store.load("certain_0").count() + store.load("certain_1").count()
    assert settled > 0 if clusters == 20 else settled < len(asked)


def vectors_of(rng, n, clusters):
    centres = rng.normal(size=(clusters, 24))
    return {i: (centres[i % clusters] + 0.35 * rng.normal(size=24)).tolist() for i in range(n)}


def test_dense_neighbours(spark):
    vectors = vectors_of(np.random.default_rng(1), 700, 30)
    vectors[700] = vectors[100]  # a tie
    rows = [*vectors.items(), (800, None), (900, [1.0, None] * 12), (1000, [0.0] * 24), (1100, [float("nan")] * 24)]
    df = spark.createDataFrame(rows, "key bigint, v array<double>")
    asked = df.where("key % 100 = 0").select("key")
    want = plain_neighbours(vectors, [k for k in vectors if k % 100 == 0], 7)
    for sizes in ({}, {"segment_rows": 90, "batch_rows": 3}):
        got = found(recommend.cosine_knn(df, "key", "v", asked, 7, **sizes))
        assert {q: [k for k, _ in near] for q, near in got.items()} == {q: [k for k, _ in near] for q, near in want.items()}
    assert recommend.cosine_knn(df.limit(0), "key", "v", asked, 7).count() == 0


def test_recall_of_random_projections(spark):
    vectors = vectors_of(np.random.default_rng(2), 6000, 300)
    df = spark.createDataFrame(list(vectors.items()), "key bigint, v array<double>")
    asked = df.where("key % 100 = 0").select("key")
    exact = found(recommend.cosine_knn(df, "key", "v", asked, 10))
    near = found(recommend.cosine_knn_approximate(df, "key", "v", asked, 10))
    hits = [len({k for k, _ in exact[q]} & {k for k, _ in near.get(q, [])}) / 10 for q in exact]
    assert len(hits) == 60 and np.mean(hits) >= 0.9


def test_embeddings_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    asked = df.where("vec_id % 100 = 0").select(F.col("vec_id").alias("key"))
    exact = found(recommend.cosine_knn(df, "vec_id", "embedding", asked, 10))
    near = found(recommend.cosine_knn_approximate(df, "vec_id", "embedding", asked, 10))
    assert np.mean([len({k for k, _ in exact[q]} & {k for k, _ in near.get(q, [])}) / 10 for q in exact]) >= 0.9


def test_bounds_drop_no_title():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdé", k=rng.randint(1, 5))) for _ in range(30)]
    for _ in range(40):
        titles = [" ".join(rng.choices(words, k=rng.randint(0, 5))) for _ in range(80)]
        block = TokenSetBlock(titles)
        for text in (" ".join(rng.choices(words, k=rng.randint(0, 5))), f"zz {words[0]}", "w" * 200):
            scores = block.scores(text)
            assert np.allclose(scores, [plain_token_set(t, text) for t in titles])
            assert (block._bounds(sorted(set(text.split()))) >= scores).all()
            for k in (1, 5, 90):
                rows, values = block.best(text, k)
                least = np.sort(scores)[-min(k, len(scores))]
                assert sorted(rows) == sorted(np.flatnonzero(scores >= least)) and (values == scores[rows]).all()


def test_long_titles_stand_in_blocks_of_their_own():
    titles = ["a" * n for n in range(1, 200)] + ["b" * 600_000, "c " * 300_000]
    blocks = link._blocks(titles)
    assert sorted(i for own, _ in blocks for i in own) == list(range(len(titles)))
    assert all(block.codes.size <= link.BLOCK_CELLS or len(own) == 1 for own, block in blocks) and len(blocks) >= 3


def test_medians_come_from_training_rows_alone(spark, store, tmp_path):
    rng = random.Random(2)
    rows = [(i, float(i % 2), None if i % 7 == 0 else rng.lognormvariate(0, 2), None if i % 5 else float(i), None) for i in range(800)]
    schema = "k bigint, t double, x double, y double, empty double"
    df = spark.createDataFrame(rows, schema)
    split, columns, filler = models.split_features(df, "k", "t", ["x", "y", "empty", "absent"], store.save, "m", models.DEFAULTS, "target")
    assert columns == ["x", "y"] and split.where("x IS NULL OR y IS NULL").count() == 0
    train = {r.k for r in split.where("NOT is_test").collect()}
    want = [float(np.median([r[c] for r in rows if r[0] in train and r[c] is not None])) for c in (2, 3)]
    assert np.allclose(filler.getOrDefault(filler.medians), want)
    # other values of test rows change nothing
    changed = df.withColumn("x", F.when(F.col("x").isNull() | F.col("k").isin(sorted(train)), F.col("x")).otherwise(F.lit(1e9)))
    again = models.split_features(changed, "k", "t", ["x", "y"], store.save, "other", models.DEFAULTS, "target")[2]
    assert again.getOrDefault(again.medians) == filler.getOrDefault(filler.medians)
    filler.write().overwrite().save(str(tmp_path / "filler"))
    read = models.MedianFillerModel.load(str(tmp_path / "filler"))
    fresh = read.transform(spark.createDataFrame([(1, None, 3.0)], "k bigint, x double, y double")).first()
    assert (fresh.x, fresh.y) == (want[0], 3.0)


def test_sketches_of_two_loads(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice("abc"), None if i % 3 else rng.randint(0, 50), None) for i in range(30_000)]
    schema = "id bigint, letter string, few int, none string"
    one = spark.createDataFrame(rows, schema)
    loads = [spark.createDataFrame(part, schema) for part in (rows[:9000], rows[7000:])]
    merged = profile.column_sketches(loads[0], "s", "monday").unionByName(profile.column_sketches(loads[1], "s", "tuesday"))
    merged = merged.unionByName(merged)  # a load that is given twice
    got = {r["column"]: r for r in profile.profile_from_sketches(merged).collect()}
    whole = {r["column"]: r for r in profile.profile_from_sketches(profile.column_sketches(one, "s", "all")).collect()}
    exact = {r["column"]: r for r in profile.profile_columns(one, "s").collect()}
    for c in ("id", "letter", "few", "none"):
        assert got[c].n_unique == whole[c].n_unique and got[c].n_rows == 32_000 and got[c].dtype == exact[c].dtype
        assert abs(whole[c].n_unique - exact[c].n_unique) <= (0.05 * exact[c].n_unique if c == "id" else 0)
        assert (whole[c].n_rows, whole[c].n_null) == (exact[c].n_rows, exact[c].n_null)
    assert profile.profile_from_sketches(profile.column_sketches(one.limit(0), "s", "none")).where("n_rows = 0 AND n_unique = 0").count() == 4


def test_sparse_search_in_small_batches_and_chunks_shuffles_no_pairs(spark, store, monkeypatch):
    rng = random.Random(3)
    texts = [(f"k{i:03}", " ".join(rng.choices("abcdefghijklmnopqrst", k=30)).replace("a", "aa")) for i in range(200)]
    texts = [(k, " ".join(w * 2 for w in t.split())) for k, t in texts] + [("k900", "bb cc bb"), ("k901", "bb cc bb"), (None, "bb cc")]
    df = spark.createDataFrame(texts, "key string, text string")
    features = store.save(recommend.tfidf_features(df, "key", "text"), "features")
    keys = df.where("key LIKE '%0'").select("key")
    want = found(recommend.sparse_knn(features, keys, 4, store.save))
    terms = {}
    for r in features.where("key IS NOT NULL").collect():
        terms.setdefault(r.key, {})[r.term] = r.weight
    for q, near in want.items():
        plain = [(-round(sum(w * terms[k].get(t, 0) for t, w in terms[q].items()), 9), k) for k in terms if k != q]
        assert [(k, -s) for s, k in sorted(x for x in plain if x[0] < 0)[:4]] == [(k, round(s, 9)) for k, s in near]
    assert len(want) == 21
    # every text shares terms with every query; what is staged of a search does not grow with these pairs
    assert store.load("best_0").count() <= 4 * len(want) * spark.sparkContext.defaultParallelism
    for name, size in (("BATCH_TERMS", 90), ("CHUNK_TERMS", 300), ("BROADCAST_ROWS", 0)):
        monkeypatch.setattr(recommend, name, size)
    assert found(recommend.sparse_knn(features, keys, 4, store.save)) == want


def test_every_document_is_asked_for(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("abcdefghijklmnopqrst", k=25)).replace("a", "aa").replace(" ", "x ")) for i in range(1, 90)]
    rows += [(1, "bx cx dx"), (None, "bx cx dx"), (95, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.QUERIES["cosine_knn_documents"](spark, str(tmp_path)).collect()
    assert len({r["query"] for r in got}) == 89
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = db.execute(registry.SQL["cosine_knn_documents"]).fetchall()
    assert sorted((r["query"], r["key"], round(r["similarity"], 6)) for r in got) == sorted(want)


def test_sparse_search_in_pieces_of_any_size(spark, store, monkeypatch):
    rng = random.Random(8)
    df = spark.createDataFrame([(i, " ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(rng.randint(1, 40)))) for i in range(150)], "key bigint, text string")
    features = recommend.tfidf_features(df, "key", "text")
    conf = spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")
    want = found(recommend.sparse_knn(features, df.select("key"), 3, store.save, together=True))
    assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == conf and len(want) > 100
    # features that stand together are stored as they come
    assert "hashpartitioning(key" not in recommend._segments(features.select("key", F.xxhash64("term").alias("number"), "weight"))._jdf.queryExecution().executedPlan().toString()
    scattered = features.repartition(7, "term")
    small = {"CHUNK_TERMS": 40, "SEGMENT_ROWS": 3, "QUERY_BLOCK": 4, "PAIRS": 9, "DENSE_TERMS": 2, "BATCH_TERMS": 700}
    for sizes in ({"DENSE_SHARE": 1}, {"DENSE_SHARE": 10**9}, small, {**small, "DENSE_SHARE": 10**9, "FEW_PAIRS": 1}, {**small, "WORTH": 1.0, "FREQUENCY_BITS": 2}):
        with monkeypatch.context() as m:
            for name, size in sizes.items():
                m.setattr(recommend, name, size)
            assert found(recommend.sparse_knn(scattered if "WORTH" in sizes else features, df.select("key"), 3, store.save, together="WORTH" not in sizes)) == want
    # a vector is in one segment
    assert store.load("segments").selectExpr("explode(keys) AS key").groupBy("key").count().where("count > 1").count() == 0
