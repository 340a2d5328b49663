"""Univariate (IQR) and multivariate (isolation forest) outlier flags. Nothing is removed."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from fusework.config import DEFAULTS, Settings
from fusework.functions.numbers import percent
from fusework.operators.dedup import keep_first
from fusework.operators.quantiles import exact_quantiles
from fusework.session import spread

IQR_COLUMNS = ("runtime_min", "budget_usd", "revenue_usd", "popularity_tmdb", "vote_count_tmdb", "roi")
ISO_FEATURES = (
    "runtime_min", "budget_usd", "revenue_usd", "popularity_tmdb", "vote_count_tmdb", "rating_normalized",
)
ISO_SKEWED = ("budget_usd", "revenue_usd", "popularity_tmdb", "vote_count_tmdb")


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )


def iqr_bounds(df: DataFrame, columns: Sequence[str], settings: Settings = DEFAULTS) -> DataFrame:
    """``(column, q1, q3, lower_bound, upper_bound)`` for all columns at once."""
    present = [c for c in columns if c in df.columns]
    quartiles = exact_quantiles(_long(df, present), "value", {"q1": 0.25, "q3": 0.75}, ["column"])
    spread = settings.iqr_multiplier * (F.col("q3") - F.col("q1"))
    return quartiles.select(
        "column", "q1", "q3",
        (F.col("q1") - spread).alias("lower_bound"),
        (F.col("q3") + spread).alias("upper_bound"),
    )


def iqr_flags(
    df: DataFrame, columns: Sequence[str], bounds: DataFrame
) -> DataFrame:
    """One ``<column>_outlier_iqr`` per column; missing values are no outliers."""
    present = [c for c in columns if c in df.columns]
    # one row per column: packed into a map and read as a scalar
    packed = bounds.agg(
        F.map_from_entries(
            F.collect_list(F.struct("column", F.struct("lower_bound", "upper_bound")))
        )
    ).scalar()
    marked = df.withColumn("__bounds", packed)

    def flag(c: str) -> Column:
        edge = F.element_at("__bounds", F.lit(c))
        outside = (F.col(c) < edge["lower_bound"]) | (F.col(c) > edge["upper_bound"])
        return F.coalesce(outside, F.lit(False)).alias(f"{c}_outlier_iqr")

    return marked.select(*df.columns, *[flag(c) for c in present])


def iqr_summary(flagged: DataFrame, bounds: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = [c for c in columns if f"{c}_outlier_iqr" in flagged.columns]
    one = flagged.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(f"{c}_outlier_iqr")).alias(c) for c in present],
    )
    counts = one.unpivot(["__rows"], present, "column", "n_outliers")
    # a column without any value has no bounds and no outliers, but it stays in the report
    return counts.join(bounds, "column", "left").select(
        "column", "lower_bound", "upper_bound", "n_outliers",
        percent(F.col("n_outliers"), F.col("__rows")).alias("pct_outliers"),
    )


# --- isolation forest (Liu, Ting and Zhou 2008) ------------------------------------------------


def _path_constant(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a tree of n rows."""
    n = np.asarray(n, dtype="float64")
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


_NODES = "tree int, node int, feature int, cut double, path double"


def _grow(features: list[str], seed: int):
    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        """One tree over at most 256 rows; node i has the children 2i+1 and 2i+2."""
        tree = int(sample["tree"].iloc[0])
        # the order of rows inside a group is not fixed; the draws must not depend on it
        data = sample.sort_values(["draw", *features])[features].to_numpy(dtype="float64")
        limit = int(np.ceil(np.log2(max(len(data), 2))))
        rng = np.random.default_rng([seed, tree])
        nodes, todo = [], [(0, 0, np.arange(len(data)))]
        while todo:
            node, depth, rows = todo.pop()
            low, high = data[rows].min(axis=0), data[rows].max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth >= limit or len(rows) <= 1 or not len(usable):
                nodes.append((tree, node, -1, 0.0, depth + float(_path_constant(len(rows)))))
                continue
            f = int(rng.choice(usable))
            cut = float(rng.uniform(low[f], high[f]))
            left = data[rows, f] <= cut
            nodes.append((tree, node, f, cut, 0.0))
            todo.append((2 * node + 1, depth + 1, rows[left]))
            todo.append((2 * node + 2, depth + 1, rows[~left]))
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "path"])

    return grow


def isolation_input(df: DataFrame, features: Sequence[str], skewed: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with one column more per feature, and their names: filled, or NULL in rows with too few values.

    Medians fill gaps for the model only. A missing value never reaches the master table.
    """
    present = [c for c in features if c in df.columns]
    numbers = {c: (F.log1p(F.col(c)) if c in skewed else F.col(c)).cast("double") for c in present}
    enough = sum(F.col(c).isNotNull().cast("int") for c in present) >= max(3, int(len(present) * 0.6))
    rows = df.where(enough).select(*[v.alias(c) for c, v in numbers.items()])
    medians = exact_quantiles(_long(rows, present), "value", {"m": 0.5}, ["column"], few_groups=True)
    packed = medians.agg(F.map_from_entries(F.collect_list(F.struct("column", "m")))).scalar()
    filled = {
        f"__iso_{c}": F.when(enough, F.coalesce(v, F.element_at("__m", F.lit(c)), F.lit(0.0))) for c, v in numbers.items()
    }
    return df.withColumn("__m", packed).withColumns(filled).drop("__m"), list(filled)


_DRAWS = 1 << 63


def isolation_pool(rows: DataFrame, n_rows: int, settings: Settings = DEFAULTS) -> tuple[DataFrame, int]:
    """A pool a few times larger than all samples together, by one hash of 63 bits, and its expected size."""
    wanted = min(n_rows, 4 * settings.iso_trees * settings.iso_sample)
    return rows.where(_draw(settings.seed, F.lit(-1)) <= _DRAWS * wanted // n_rows - 1), wanted


def _draw(seed: int, salt: Column) -> Column:
    return F.xxhash64(F.lit(seed), salt, F.col("key")).bitwiseAND(F.lit(_DRAWS - 1))


def isolation_nodes(rows: DataFrame, n_rows: int, settings: Settings = DEFAULTS) -> DataFrame:
    """The trees over ``rows`` (key and features) as a node table.

    Every tree draws its rows by a hash of (seed, tree, key), so partitioning and retries do not
    change the sample, and only drawn rows reach the shuffle.
    """
    features = [c for c in rows.columns if c != "key"]
    pool, pool_rows = isolation_pool(rows, n_rows, settings)
    # twice the rows a tree needs; fewer are left out below
    limit = min(_DRAWS, 2 * _DRAWS * settings.iso_sample // pool_rows) - 1
    trees = F.transform(
        F.sequence(F.lit(0), F.lit(settings.iso_trees - 1)),
        lambda t: F.struct(t.alias("tree"), _draw(settings.seed, t).alias("draw")),
    )
    drawn = pool.withColumn("t", F.explode(F.filter(trees, lambda s: s["draw"] <= limit)))
    sample = keep_first(
        drawn.select(*features, "t.tree", "t.draw"),
        ["tree"], [F.col("draw").asc(), *[F.col(c).asc() for c in features]], n=settings.iso_sample,
    )
    return sample.groupBy("tree").applyInPandas(_grow(features, settings.seed), _NODES)


def _full_trees(feature: np.ndarray, cut: np.ndarray, path: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, cut) of all nodes above level ``depth``, and the path lengths of that level: every row takes ``depth`` steps.

    A leaf further up sends every row to its left child, which has its path length.
    """
    feature, cut, path = feature.copy(), cut.copy(), path.copy()
    above = 2**depth - 1
    for node in range(above):
        leaf = feature[:, node] < 0
        path[leaf, 2 * node + 1] = path[leaf, node]
        cut[leaf, node] = np.inf
    return np.maximum(feature[:, :above], 0).astype(np.intp), cut[:, :above], path[:, above : 2 * above + 1]


def isolation_scorer(nodes: DataFrame, features: list[str], sample: int, trees: int) -> Column:
    """The score of a row as a column. The model is bounded (trees times two nodes per sampled row), not the data."""
    model = nodes.toPandas()
    depth = int(np.ceil(np.log2(max(sample, 2))))
    width = 2 ** (depth + 1)
    order = {t: i for i, t in enumerate(sorted(model["tree"].unique()))}
    if len(order) < trees:
        raise ValueError(f"{trees - len(order)} of {trees} trees drew no rows")
    feature = np.full((len(order), width), -1, dtype=np.int32)
    cut, path = np.zeros((len(order), width)), np.zeros((len(order), width))
    at = model["tree"].map(order).to_numpy(), model["node"].to_numpy()
    feature[at], cut[at], path[at] = model["feature"], model["cut"], model["path"]
    scale = float(_path_constant(np.array(sample)))
    shared = nodes.sparkSession.sparkContext.broadcast(_full_trees(feature, cut, path, depth))

    @F.pandas_udf("double")
    def score(x: pd.DataFrame) -> pd.Series:
        feature, cut, path = shared.value
        columns = np.ascontiguousarray(x.to_numpy(dtype="float64").T)
        n, values = columns.shape[1], columns.ravel()
        total, lane = np.zeros(n), np.arange(n)
        for t in range(len(path)):
            # the root has one feature; below it each row looks up its node, counted within its level
            node = (columns[feature[t, 0]] > cut[t, 0]).astype(np.intp)
            for level in range(1, depth):
                own = slice(2**level - 1, 2 ** (level + 1) - 1)
                place = (feature[t, own] * n).take(node)
                place += lane
                right = values.take(place) > cut[t, own].take(node)
                node += node
                node += right
            total += path[t].take(node)
        return pd.Series(2.0 ** (-total / len(path) / scale))

    return score(F.struct(*features))


def isolation_forest(
    df: DataFrame,
    key: str,
    stage,
    features: Sequence[str] = ISO_FEATURES,
    skewed: Sequence[str] = ISO_SKEWED,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Adds ``multivariate_outlier_iso``: about the 3 % of scored rows that isolate most easily.

    With fewer than ``iso_min_rows`` rows nothing is judged and the flag is NULL.
    Rows are scored where they stand, so keys may repeat; ``key`` only draws the samples. ``stage`` writes
    a table and reads it back: features and scores are read more than once.
    """
    filled, names = isolation_input(df, features, skewed)
    rows = spread(stage(filled, "iso_input"))
    usable = rows.where(F.col(names[0]).isNotNull())
    n_rows = usable.count()
    if n_rows < settings.iso_min_rows:
        return df.withColumn("multivariate_outlier_iso", F.lit(None).cast("boolean"))
    nodes = isolation_nodes(usable.select(F.col(key).alias("key"), *names), n_rows, settings)
    score = isolation_scorer(nodes, names, min(settings.iso_sample, n_rows), settings.iso_trees)
    scored = rows.withColumn("__iso_score", F.when(F.col(names[0]).isNotNull(), score)).drop(*names)
    scored = stage(scored, "iso_scores")
    cut = exact_quantiles(scored, "__iso_score", {"cut": 1.0 - settings.iso_contamination}).select("cut").scalar()
    flag = F.coalesce(F.col("__iso_score") > cut, F.lit(False))
    return scored.withColumn("multivariate_outlier_iso", flag).drop("__iso_score")


def flag_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith("_outlier_iqr") or c == "multivariate_outlier_iso"]


def any_outlier_flag(df: DataFrame) -> DataFrame:
    flags = flag_columns(df)
    combined = F.greatest(*flags) if len(flags) > 1 else F.col(flags[0])
    return df.withColumn("any_outlier_flag", combined)


def outliers_by_type(df: DataFrame, by: str = "record_type") -> DataFrame:
    return df.groupBy(by).agg(*[F.count_if(F.col(c)).alias(c) for c in flag_columns(df)])
