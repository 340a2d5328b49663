"""Operators against brute force, under skew and under different partitioning."""

import random

import pytest
from pyspark.sql import functions as F

from fusework.config import Settings
from fusework.operators import dedup, golden, link, models, outliers, recommend, reports
from fusework.operators.quantiles import exact_quantiles
from fusework.plans.stages import CatalogRun
from fusework.session import IntegrityError
from fusework.sources import catalog_csv as csv
from fusework.sources.fixtures import cat_a, cat_b
from tests.test_functions import plain_lcs, plain_token_set


def explain(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_limits_rows_before_the_shuffle(spark):
    # one key holds most rows
    df = spark.range(10_000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), "id")
    one = dedup.keep_first(df, ["k"], ["id"])
    assert one.count() == df.select("k").distinct().count()
    plan = explain(one)
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")
    assert "Partial" in plan


def test_exact_quantiles_on_skewed_groups(spark):
    import numpy as np

    rng = random.Random(3)
    rows = [("hot", rng.lognormvariate(0, 3)) for _ in range(5000)] + [("tie", 7.0)] * 500
    rows += [(f"g{i}", float(i)) for i in range(20)] + [(None, 1.0), ("hot", None), ("hot", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = {"a": 0.0, "b": 0.013, "c": 0.5, "d": 0.97, "e": 1.0}
    got = {r["g"]: r for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    for g in ("hot", "tie", "g4"):
        values = [v for k, v in rows if k == g and v is not None and v == v]
        assert got[g]["__n"] == len(values)
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p))
    assert None not in got
    whole = exact_quantiles(df, "v", {"m": 0.5}).first()
    assert whole["m"] == pytest.approx(np.median([v for _, v in rows if v is not None and v == v]))


LINK = (
    "row_id bigint, ext_id string, title_display string, title_norm string, release_year int, "
    "runtime_min double, genre_set array<string>, first_letter string, main_token string"
)


def link_side(spark, titles, years, runtimes=None):
    rows = [
        (i, str(i), t, t, y, runtimes[i] if runtimes else None, [], t[0], t.split()[0])
        for i, (t, y) in enumerate(zip(titles, years))
    ]
    return spark.createDataFrame(rows, LINK)


def best_five(a, b):
    """Brute force of the blocked top five."""
    out = set()
    for (bt, by) in b:
        block = [
            (-plain_token_set(at, bt), i) for i, (at, ay) in enumerate(a) if at[0] == bt[0] and abs(ay - by) <= 1
        ]
        out |= {(bt, by, i) for _, i in sorted(block)[:5]}
    return out


def test_fuzzy_top_k_equals_brute_force_when_a_block_is_cut_into_pieces(spark):
    rng = random.Random(11)
    words = ["red", "rose", "river", "rain", "of", "no", "rock", "run", "rod"]
    title = lambda: "r" + " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
    # one block holds everything, a third of it copies of one title
    a = [("rthe same title", 2000)] * 60 + [(title(), rng.choice([1999, 2000, 2001])) for _ in range(120)]
    b = list({(title(), rng.choice([1999, 2000])) for _ in range(40)} | {("rthe same title", 2001)})
    side_a, side_b = link_side(spark, *zip(*a)), link_side(spark, *zip(*b))
    tiny = Settings(block_rows_a=17, block_rows_b=7)
    for settings in (Settings(), tiny):
        top = link.fuzzy_top_k(side_a, side_b, settings)
        got = {(r["b_key"], r["b_year"], r["a_row_id"]) for r in top.collect()}
        assert got == best_five(a, b)
    row = link.fuzzy_top_k(side_a, side_b, tiny).where("ratio < 100").first()
    assert row["ratio"] == pytest.approx(
        200 * plain_lcs(row["b_key"], a[row["a_row_id"]][0]) / (len(row["b_key"]) + len(a[row["a_row_id"]][0]))
    )


def plain_resolve(pairs):
    """Sort by score, keep the first per a, then the first per b."""
    ordered = sorted(pairs, key=lambda p: (-p[2], p[0], p[1]))
    seen, kept = set(), []
    for p in sorted(ordered, key=lambda p: (-p[2], p[1])):
        if p[0] not in seen:
            seen.add(p[0])
            kept.append(p)
    seen, out = set(), []
    for p in sorted(kept, key=lambda p: (-p[2], p[0])):
        if p[1] not in seen:
            seen.add(p[1])
            out.append(p)
    return set(out)


def test_one_to_one(spark):
    rng = random.Random(2)
    pairs = [(rng.randint(0, 30), rng.randint(0, 30), float(rng.randint(80, 90))) for _ in range(300)]
    pairs = list({(a, b): (a, b, s) for a, b, s in pairs}.values())
    df = spark.createDataFrame(pairs, "a_row_id bigint, b_row_id bigint, linkage_score double")
    assert {tuple(r) for r in link.resolve_one_to_one(df).collect()} == plain_resolve(pairs)


def test_representatives_do_not_change_exact_and_near_year_matches(spark):
    """All pairs, scored and resolved, give what the aggregated joins give."""
    rng = random.Random(4)
    titles = ["hot title"] * 40 + [rng.choice(["aa", "bb", "cc"]) for _ in range(40)]
    years = [rng.choice([2000, 2001, 2002]) for _ in titles]
    runs = [rng.choice([None, 90.0, 100.0, 140.0]) for _ in titles]
    a = link_side(spark, titles, years, runs)
    b = link_side(spark, titles[20:70], years[10:60], runs[30:80])
    left, right = a.collect(), b.collect()

    def near(x, y):
        if x["title_norm"] != y["title_norm"] or abs(x["release_year"] - y["release_year"]) > 1:
            return None
        parts = [(0.6, 100.0), (0.25, 100.0 if x["release_year"] == y["release_year"] else 70.0)]
        if x["runtime_min"] is not None and y["runtime_min"] is not None:
            gap = abs(x["runtime_min"] - y["runtime_min"])
            parts.append((0.1, 100.0 if gap <= 5 else 0.0 if gap >= 60 else 100 * (1 - gap / 60)))
        return sum(w * v for w, v in parts) / sum(w for w, _ in parts)

    pairs = [(x["row_id"], y["row_id"], near(x, y)) for x in left for y in right if near(x, y) is not None]
    want = {(i, j) for i, j, _ in plain_resolve([(i, j, round(s, 9)) for i, j, s in pairs])}
    got = {(r["a_row_id"], r["b_row_id"]) for r in link.match_year_pm1(a, b).collect()}
    assert got == want
    exact = [(i, j, 100.0) for i, j, _ in pairs
             if left[i]["release_year"] == right[j]["release_year"]]
    got = {(r["a_row_id"], r["b_row_id"]) for r in link.match_exact(a, b).collect()}
    assert got == {(i, j) for i, j, _ in plain_resolve(exact)}


@pytest.fixture(scope="module")
def run(spark, sf_dir):
    from fusework.session import StageStore

    # the smallest tables hold too few rows for the forest
    big = sf_dir.replace("sf0.001", "sf0.01")
    return CatalogRun(cat_a(spark, big), cat_b(spark, big), StageStore(spark))


def test_cascade_is_one_to_one_and_finds_the_truth(run):
    matches = run.matches.cache()
    n = matches.count()
    assert matches.select("a_row_id").distinct().count() == n
    assert matches.select("b_row_id").distinct().count() == n
    strong = link.strong_only(matches)
    right = strong.where(F.col("b_row_id") % 1_000_000_000 == F.col("a_row_id")).count()
    assert right / strong.count() > 0.95
    assert strong.count() / run.links[1].count() > 0.8


def test_cascade_does_not_depend_on_partitions(run, spark):
    from fusework.session import StageStore

    other = CatalogRun(run.raw_a.repartition(13), run.raw_b.repartition(3), StageStore(spark))
    key = ["a_row_id", "b_row_id", "match_method", "match_status"]
    assert other.matches.select(key).exceptAll(run.matches.select(key)).count() == 0
    assert other.matches.count() == run.matches.count()


def test_master_identity_and_audit(run):
    from fusework.operators.audit import audit_checks

    expected = run.clean_a.count() + run.clean_b.count() - run.strong.count()
    assert run.master.count() == expected
    ids = [r[0] for r in run.master.select("movie_master_id").orderBy("movie_master_id").collect()]
    assert ids == [f"M_{i:07d}" for i in range(1, expected + 1)]
    failed = audit_checks(run.clean_a, run.clean_b, run.strong, run.master).where("status = 'FAIL'").collect()
    assert failed == []


def test_ids_follow_the_order_with_uneven_keys(spark, store):
    rows = [(i if i % 3 else i + 10**9, "x" if i % 2 else "y") for i in range(500)]
    df = spark.createDataFrame(rows, "k bigint, t string").repartition(7)
    got = golden.assign_master_id(df, ["y", "x"], "t", "k", "id", store.save, slice_rows=40).orderBy("id").collect()
    want = sorted(rows, key=lambda r: (r[1] != "y", r[0]))
    assert [(r["k"], r["t"]) for r in got] == want
    assert [r["id"] for r in got] == [f"M_{i:07d}" for i in range(1, 501)]


def test_ten_million_ids_keep_the_order(spark, store):
    n = 10_000_050
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.lit("x").alias("t"))
    ids = golden.assign_master_id(df, ["x"], "t", "k", "id", store.save, n_rows=n)
    wrong = ids.where((golden.master_sequence(F.col("id")) != F.col("k") + 1) | (F.length("id") < 9))
    assert wrong.count() == 0 and ids.count() == n
    # no range has much more than its share
    sizes = store.load("id_ranges").groupBy(F.shiftright("__spot", 33)).count().agg(F.max("count")).first()[0]
    assert sizes < 2 * golden.SLICE_ROWS
    store.clear()


@pytest.mark.parametrize("rows", [[(1, "x"), (1, "x")], [(None, "x"), (2, "x")], [(1, "x"), (2, "z")]])
def test_ids_need_different_orders(spark, store, rows):
    df = spark.createDataFrame(rows, "k bigint, t string")
    with pytest.raises(IntegrityError):
        golden.assign_master_id(df, ["x"], "t", "k", "id", store.save)
    assert golden.assign_master_id(spark.createDataFrame([], "k bigint, t string"), ["x"], "t", "k", "other", store.save).count() == 0


def test_a_broken_stage_is_not_published(spark, store):
    score = "a_row_id bigint, b_row_id bigint, linkage_score double"
    good = [(1, 10, 100.0), (2, 20, 75.5)]
    for more in ([(1, 30, 80.0)], [(3, 10, 80.0)], [(None, 30, 80.0)], [(3, 30, 101.0)], [(3, 30, None)]):
        flagged, checks, helpers = link.one_to_one(spark.createDataFrame(good + more, score))
        with pytest.raises(IntegrityError):
            store.save(flagged, "matches", checks=checks, helpers=helpers)
        assert not store.published("matches")
    flagged, checks, helpers = link.one_to_one(spark.createDataFrame(good, score))
    saved = store.save(flagged, "matches", checks=checks, helpers=helpers)
    assert sorted(map(tuple, saved.collect())) == good and store.metrics("matches")["rows"] == 2
    checks, counts, verify = golden.golden_checks(3, 2, 1)
    rows = [("merged", 1), ("tmdb_only", 2), ("tmdb_only", 3), ("imdb_only", 4)]
    master = spark.createDataFrame([(t, f"M_{i:07d}") for t, i in rows], "record_type string, movie_master_id string")
    assert store.save(master, "master", checks=checks, counts=counts, verify=verify).count() == 4
    short = master.where("movie_master_id <> 'M_0000003'")
    twice = master.unionByName(master.limit(1))
    nameless = master.withColumn("movie_master_id", F.expr("nullif(movie_master_id, 'M_0000002')"))
    for broken in (short, twice, nameless, master.replace("imdb_only", "merged")):
        with pytest.raises(IntegrityError):
            store.save(broken, "master", checks=checks, counts=counts, verify=verify)
    # the earlier one is still there
    assert store.load("master").count() == 4


def test_a_run_goes_on_where_an_earlier_one_ended(spark, tmp_path):
    from fusework.plans import stages
    from fusework.session import StageStore

    def write(extra):
        for name, make in (("a", cat_a), ("b", cat_b)):
            rows = make(spark, "/root/testdata/sf0.001")
            (rows.unionByName(rows.limit(1)) if extra and name == "a" else rows).write.mode("overwrite").parquet(f"{tmp_path}/{name}")

    def run():
        raw = [spark.read.parquet(f"{tmp_path}/{n}") for n in "ab"]
        return stages.CatalogRun(*raw, StageStore(spark, f"{tmp_path}/run"), isolation=False)

    write(extra=False)
    first = run()
    stages.run_stages(first, steps=[1, 2, 3])
    folder = first.store.path("master_plain")

    def fails(_):
        raise RuntimeError("lost")

    kept, stages.STAGES[3] = stages.STAGES[3], fails
    try:
        again = run()
        assert set(stages.run_stages(again, steps=[1, 2, 3])) >= {"match_audit", "profile_before"}
        assert again.master_plain.count() == first.master_plain.count() and again.store.path("master_plain") == folder
        # other inputs or settings find nothing
        other = stages.CatalogRun(again.raw_a, again.raw_b, StageStore(spark, f"{tmp_path}/run"), layers=("exact",), isolation=False)
        assert not other.store.published("matches")
        write(extra=True)
        with pytest.raises(RuntimeError):
            stages.run_stages(run(), steps=[3])
    finally:
        stages.STAGES[3] = kept
    changed = run()
    assert changed.master_plain.count() > 0 and changed.store.path("master_plain") != folder
    changed.store.discard("matches")
    assert not changed.store.published("matches")


def test_isolation_forest_flags_planted_rows_and_is_stable(spark):
    from fusework.session import StageStore

    rng = random.Random(9)
    rows = [(i, rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(2000)]
    rows += [(10_000 + i, 15.0 + i, -15.0 - i, 12.0) for i in range(10)]
    df = spark.createDataFrame(rows, "k bigint, a double, b double, c double")

    def flagged(frame):
        out = outliers.isolation_forest(frame, "k", StageStore(spark).save, ["a", "b", "c"], [])
        return {r[0] for r in out.where("multivariate_outlier_iso").select("k").collect()}

    first = flagged(df)
    assert set(range(10_000, 10_010)) <= first
    assert 0.02 < len(first) / len(rows) < 0.04
    assert flagged(df.repartition(11)) == first


def test_isolation_forest_keeps_rows_with_repeated_keys(spark):
    from fusework.session import StageStore

    rng = random.Random(5)
    rows = [(i % 40, rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(300)]
    df = spark.createDataFrame(rows, "k bigint, a double, b double, c double")
    out = outliers.isolation_forest(df, "k", StageStore(spark).save, ["a", "b", "c"], [])
    assert out.count() == 300 and out.drop("multivariate_outlier_iso").exceptAll(df).count() == 0


def test_isolation_pool_of_a_very_large_table_is_not_empty(spark):
    # a hundred million keys stand for a table a thousand times their number
    settings = Settings(iso_trees=100, iso_sample=256)
    pool, wanted = outliers.isolation_pool(spark.range(100_000_000).withColumnRenamed("id", "key"), 10**11, settings)
    assert wanted == 102_400 and 50 < pool.count() < 180
    rare, _ = outliers.isolation_pool(spark.range(10).withColumnRenamed("id", "key"), 10**12, settings)
    assert rare.count() == 0


def test_iqr_summary_keeps_a_column_without_values(spark):
    df = spark.createDataFrame([(float(i), None) for i in range(20)] + [(900.0, None)], "a double, b double")
    bounds = outliers.iqr_bounds(df, ["a", "b"])
    got = {r["column"]: r for r in outliers.iqr_summary(outliers.iqr_flags(df, ["a", "b"], bounds), bounds, ["a", "b"]).collect()}
    assert got["a"]["n_outliers"] == 1 and got["b"]["n_outliers"] == 0 and got["b"]["lower_bound"] is None


def test_split_is_stratified_and_stable(spark):
    df = spark.range(4000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 10 == 0).alias("y"))
    split = models.train_test_split(df, "k", stratify="y")
    shares = {r["y"]: r["s"] for r in split.groupBy("y").agg(F.avg(F.col("is_test").cast("int")).alias("s")).collect()}
    assert shares[True] == pytest.approx(0.25, abs=0.01) and shares[False] == pytest.approx(0.25, abs=0.01)
    again = models.train_test_split(df.repartition(9), "k", stratify="y")
    assert again.exceptAll(split).count() == 0


def test_models_learn(run):
    profit = models.profitability_models(run.master, "movie_master_id", run.stage)
    best = profit.first()
    assert best["roc_auc"] > 0.6 and best["n_train"] > best["n_test"] > 0
    assert models.profitability_models(run.master.limit(20), "movie_master_id", lambda df, name: df).count() == 0


def test_recommender_unknown_title_gives_nothing(run):
    assert recommend.recommend(run.master, run.features, ["no such film"]).count() == 0
    title = run.master.where("record_type = 'merged'").first()["title_display"]
    near = recommend.recommend(run.master, run.features, [title.upper()], n=3).collect()
    assert len(near) == 3 and all(0 <= r["similarity_score"] <= 1 for r in near)


def test_csv_dialects(spark, tmp_path):
    (tmp_path / "b.csv").write_text(
        'Movie Title,Plot-Kyeword,Year\n'
        '"He said ""hi"", then left",x,1\n'
        '"A \\"quoted\\" word, and \\\\ slash",NA,2\n'
        'plain,,3\n'
    )
    got = csv.load_csv_source(spark, str(tmp_path / "b.csv"), "imdb", backslash_escapes=True)
    assert got.columns == ["movie_title", "plot_kyeword", "year", "_source"]
    rows = {r["year"]: (r["movie_title"], r["plot_kyeword"]) for r in got.collect()}
    assert rows == {
        "1": ('He said "hi", then left', "x"), "2": ('A "quoted" word, and \\ slash', None), "3": ("plain", None),
    }
    (tmp_path / "a.csv").write_text('ID,Title\n1,"two\nlines"\n2,"a ""b"", c"\n')
    a = csv.load_csv_source(spark, str(tmp_path / "a.csv"), "tmdb", multi_line=True)
    assert {r["id"]: r["title"] for r in a.collect()} == {"1": "two\nlines", "2": 'a "b", c'}


def test_match_audit_reads_one_folder_per_status(run, spark, tmp_path):
    path = csv.write_match_audit(run.matches, str(tmp_path / "audit"))
    probable = spark.read.parquet(path).where("match_status = 'probable_match'")
    assert probable.count() == link.review_set(run.matches, "probable_match").count()
    assert "PartitionFilters: [isnotnull(match_status" in explain(probable)


def test_report_scans_are_pruned_and_filtered(run):
    plan = explain(reports.m_q9_decade_profitability(run.master))
    assert "EqualTo(record_type,merged)" in plan
    assert "overview" not in plan.split("ReadSchema:")[1]
