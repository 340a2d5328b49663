"""Forests grown beside the data: splits against brute force, and the same trees whatever is grown where."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fusework.operators import forest, models


def test_edges_of_bins():
    assert forest.bin_edges(np.array([3.0, 1.0, 1.0, 2.0])).tolist() == [1.5, 2.5]
    assert forest.bin_edges(np.array([7.0, 7.0])).tolist() == []
    many = forest.bin_edges(np.random.default_rng(1).normal(size=5000))
    counts = np.bincount(np.searchsorted(many, np.random.default_rng(1).normal(size=5000)))
    assert len(many) == 31 and counts.min() > 150 and counts.max() < 163


def test_trees_take_the_best_split_and_end_at_pure_leaves(monkeypatch):
    rng = np.random.default_rng(3)
    bins, y, weight = rng.integers(0, 9, (300, 4)).astype(np.uint8), rng.normal(size=300), rng.integers(1, 4, 300).astype(float)
    for size in (forest.SLICE_NODES, 3):
        monkeypatch.setattr(forest, "SLICE_NODES", size)
        feature, cut, left, value = forest.grow(bins, weight, y, 30, 4, np.random.default_rng(0))
        spread = lambda rows: (weight[rows] * (y[rows] - np.average(y[rows], weights=weight[rows])) ** 2).sum()
        best = min((spread(bins[:, f] <= c) + spread(bins[:, f] > c), f, c) for f in range(4) for c in range(8))
        assert (feature[0], cut[0]) == best[1:] and value[0] == pytest.approx(np.average(y, weights=weight))
        ends = forest._follow(bins, np.zeros(300, np.int64), feature, cut, left)
        rows = [tuple(b) for b in bins]
        means = {r: np.average(y[[k == r for k in rows]], weights=weight[[k == r for k in rows]]) for r in rows}
        assert np.allclose(value[ends], [means[r] for r in rows])
    # no deeper than asked
    assert len(forest.grow(bins, weight, y, 2, 4, np.random.default_rng(0))[0]) <= 7


def _rows(spark, n):
    x = spark.range(n).select(
        F.col("id").cast("string").alias("k"), *[(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(1000)) / 10.0).alias(c) for c in "abc"]
    )
    noise = F.pmod(F.xxhash64("k", F.lit("z")), F.lit(100)) / 20.0
    return x.withColumn("target", F.col("a") + F.when(F.col("b") > 50, 30.0).otherwise(0.0) + noise)


def test_the_same_forest_whatever_is_grown_where(spark, store, monkeypatch):
    rows = _rows(spark, 3000).withColumn("target", F.floor("target").cast("double"))
    train, test = rows.where("CAST(k AS INT) % 4 > 0"), rows.where("CAST(k AS INT) % 4 = 0")

    def predicted(name):
        grown = forest.fit_forest(train, "k", list("abc"), store.save, name, 7, 12, 5, 3)
        out = forest.predict_forest(grown, test, list("abc"))
        return grown, sorted((r.target, round(r.value, 9)) for r in out.collect())

    whole, want = predicted("whole")
    assert len(whole.top["feature"]) == 7 and whole.units.count() == 7 and len(want) == 750
    t, v = np.array(want).T
    assert 1 - ((t - v) ** 2).sum() / ((t - t.mean()) ** 2).sum() > 0.97
    monkeypatch.setattr(forest, "LOCAL_ROWS", 300)
    monkeypatch.setattr(forest, "ROUND_BYTES", 4000)
    monkeypatch.setattr(forest, "MOST_TASKS", 5)
    parts, got = predicted("parts")
    # the driver has the nodes above those of 300 rows; all others stay in the stored table
    assert len(parts.top["feature"]) > 40 and parts.units.count() == (parts.top["feature"] == forest.LOCAL).sum() > 30
    assert got == want
    # every node is split from sums, down to the leaves
    monkeypatch.setattr(forest, "LOCAL_ROWS", 0)
    top, got = predicted("top")
    assert top.units.count() == 0 and np.allclose(got, want)
    assert top.top["level"].max() <= 12


def test_models_do_not_grow_forests_in_the_driver(spark, store):
    rows = _rows(spark, 900).withColumn("y", (F.col("target") > 70).cast("int"))
    profit = models.profitability_models(rows, "k", store.save, "y", list("abc")).collect()
    assert {r.model for r in profit} == {"RandomForest", "LogisticRegression"} and all(r.roc_auc > 0.9 for r in profit)
    revenue = models.revenue_models(rows, "k", store.save, "target", list("abc")).collect()
    assert {r.model: r.r2 > 0.9 for r in revenue if r.model != "Ridge"} == {"RandomForestRegressor": True, "GradientBoosting": True}
    assert store.load("profit_forest").count() == store.load("revenue_forest").count() == models.DEFAULTS.rf_trees
