"""What keeps the outlier queries within their limits of time and disk."""

import numpy as np
from pyspark.sql import functions as F

from fusework.operators import audit, outliers
from fusework.operators.quantiles import exact_quantiles


def test_full_trees_give_the_path_lengths_of_the_leaves():
    rng = np.random.default_rng(5)
    depth, trees = 4, 30
    feature, cut, path = np.full((trees, 32), -1), np.zeros((trees, 32)), np.zeros((trees, 32))
    for t in range(trees):
        todo = [(0, 0)]
        while todo:
            node, level = todo.pop()
            if level == depth or rng.random() < 0.3:
                path[t, node] = rng.random()
                continue
            feature[t, node], cut[t, node] = rng.integers(3), rng.normal()
            todo += [(2 * node + 1, level + 1), (2 * node + 2, level + 1)]
    own, cuts, ends = outliers._full_trees(feature, cut, path, depth)
    for row in [*rng.normal(size=(50, 3)), np.array([np.nan, np.inf, -np.inf])]:
        for t in range(trees):
            node = at = 0
            while feature[t, node] >= 0:
                node = 2 * node + 1 + bool(row[feature[t, node]] > cut[t, node])
            for _ in range(depth):
                at = 2 * at + 1 + bool(row[own[t, at]] > cuts[t, at])
            assert ends[t, at - (2**depth - 1)] == path[t, node]


def test_quantiles_of_few_groups_shuffle_no_rows(spark):
    rows = spark.range(20_000).select((F.col("id") % 3).cast("string").alias("g"), F.xxhash64("id").cast("double").alias("v"))
    probs = {"m": 0.5, "h": 0.9}
    plain, few = (exact_quantiles(rows, "v", probs, ["g"], few_groups=k) for k in (False, True))
    assert sorted(few.collect()) == sorted(plain.select(few.columns).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = few._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_histograms_are_planned_once(spark):
    rows = [(float(i % 97) ** 2,) for i in range(900)] + [(1e9,), (None,)]
    df = spark.createDataFrame(rows, "v double")
    found = audit.winsor_histogram(df, "v", bins=7)
    values = np.array([v for v, in rows if v is not None])
    low, high = np.quantile(values, [0.01, 0.99])
    assert [r.n for r in found.orderBy("bin").collect()] == np.histogram(np.clip(values, low, high), 7)[0].tolist()
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") < 40
    for odd in (df.where("v IS NULL"), df.where("false"), spark.createDataFrame([(float("nan"),)], "v double")):
        assert audit.winsor_histogram(odd, "v", bins=3).count() == 3
