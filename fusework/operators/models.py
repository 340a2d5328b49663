"""Predictive models on Spark ML: profitability (classification) and revenue (regression)."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from fusework.config import DEFAULTS, Settings
from fusework.operators.forest import fit_forest, predict_forest
from fusework.operators.quantiles import attach, exact_quantiles
from fusework.session import shared_dir

PROFIT_FEATURES = ("budget_usd", "runtime_min", "popularity_tmdb", "vote_count_tmdb", "release_year")
REVENUE_FEATURES = ("log_budget", "runtime_min", "popularity_tmdb", "vote_count_tmdb", "release_year")


PROFIT_REPORT = "model string, accuracy double, f1 double, roc_auc double, n_train bigint, n_test bigint"
REVENUE_REPORT = "model string, r2 double, mae_log double, n_train bigint, n_test bigint"


class MedianFiller(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the exact median of each input column; its model fills gaps with them."""

    def __init__(self, inputCols: Sequence[str] = ()):
        super().__init__()
        self._set(inputCols=list(inputCols))

    def _fit(self, dataset: DataFrame) -> MedianFillerModel:
        columns = self.getInputCols()
        values = dataset.select(*[F.col(c).cast("double").alias(c) for c in columns])
        medians = exact_quantiles(values.unpivot([], columns, "column", "value"), "value", {"m": 0.5}, ["column"])
        found = {r["column"]: r["m"] for r in medians.collect()}  # one number for each column
        # a column without any value has no median and keeps its gaps
        known = [c for c in columns if c in found]
        return MedianFillerModel(known, [float(found[c]) for c in known])


class MedianFillerModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fills gaps with what was learned, in any table with these columns; can be stored and read again."""

    medians = Param(Params._dummy(), "medians", "the medians of the input columns", TypeConverters.toListFloat)

    def __init__(self, inputCols: Sequence[str] = (), medians: Sequence[float] = ()):
        super().__init__()
        self._set(inputCols=list(inputCols), medians=list(medians))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        filled = zip(self.getInputCols(), self.getOrDefault(self.medians))
        return dataset.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in filled})


def model_rows(df: DataFrame, key: str, target: str, features: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """(key, target, features) of the rows with a target and at least one feature, and the features that ``df`` has."""
    present = [c for c in features if c in df.columns]
    rows = df.where(F.col(target).isNotNull()).select(
        key, F.col(target).cast("double").alias("target"), *[F.col(c).cast("double").alias(c) for c in present]
    )
    return rows.where(F.coalesce(*present).isNotNull()), present


def prepare_features(df: DataFrame, key: str, target: str, features: Sequence[str]) -> DataFrame:
    """Rows with a target and at least one feature, gaps filled with the exact median of all of them."""
    rows, present = model_rows(df, key, target, features)
    return MedianFiller(present).fit(rows).transform(rows)


def split_features(df: DataFrame, key: str, target: str, features: Sequence[str], stage, name: str, settings: Settings,
                   stratify: str | None = None) -> tuple[DataFrame, list[str], MedianFillerModel]:
    """(rows with ``is_test``, features, filler): gaps are filled with medians of the training rows alone."""
    rows, present = model_rows(df, key, target, features)
    split = stage(train_test_split(rows, key, settings, stratify), f"{name}_split")
    filler = MedianFiller(present).fit(split.where(~F.col("is_test")))
    return stage(filler.transform(split), f"{name}_features"), filler.getInputCols(), filler


def train_test_split(
    df: DataFrame, key: str, settings: Settings = DEFAULTS, stratify: str | None = None
) -> DataFrame:
    """Adds ``is_test``. The draw is a hash of the key, so it survives any repartitioning.

    Stratified, the cut is an exact quantile of the draws of each class.
    """
    draw = F.pmod(F.xxhash64(F.lit(settings.seed), F.col(key)), F.lit(1 << 52)).cast("double") / float(1 << 52)
    drawn = df.withColumn("__draw", draw)
    if stratify is None:
        return drawn.select(*df.columns, (F.col("__draw") < settings.test_size).alias("is_test"))
    cuts = exact_quantiles(drawn, "__draw", {"__cut": settings.test_size}, [stratify]).drop("__n")
    return attach(drawn, cuts, [stratify], "__cut").select(*df.columns, (F.col("__draw") <= F.col("__cut")).alias("is_test"))


def _fit_all(split: DataFrame, features: list[str], models: dict) -> dict[str, DataFrame]:
    """Test predictions per model.

    Fitted models are stored and read again: a model in memory drags its training summary, and with it the session,
    into its tasks.
    """
    spark = split.sparkSession
    assembled = VectorAssembler(inputCols=features, outputCol="features").transform(split).select(
        "target", "is_test", "features"
    )
    train = assembled.where(~F.col("is_test")).persist()
    test = assembled.where("is_test")
    root, predicted = f"{shared_dir(spark)}/models-{uuid.uuid4().hex}", {}
    try:
        for name, model in models.items():
            Pipeline(stages=[model]).fit(train).write().save(f"{root}/{name}")
            predicted[name] = PipelineModel.load(f"{root}/{name}").transform(test)
    finally:
        train.unpersist()
    return predicted


def _forest_predictions(split: DataFrame, key: str, features: list[str], stage, name: str, per_node: int, settings: Settings) -> DataFrame:
    """(target, value) of the test rows, by a forest of the training rows."""
    forest = fit_forest(
        split.where(~F.col("is_test")), key, features, stage, name, settings.rf_trees, settings.rf_depth, settings.seed, per_node
    )
    return predict_forest(forest, split.where("is_test"), features)


def _sizes(split: DataFrame) -> tuple[int, int]:
    row = split.agg(F.count_if(~F.col("is_test")), F.count_if("is_test")).first()
    return row[0], row[1]


def profitability_models(
    df: DataFrame,
    key: str,
    stage,
    target: str = "is_profitable",
    features: Sequence[str] = PROFIT_FEATURES,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Random forest against logistic regression; no rows below the minimum number of rows."""
    split, columns, _ = split_features(df, key, target, features, stage, "profit", settings, stratify="target")
    n_train, n_test = _sizes(split)
    if n_train + n_test < settings.min_model_rows:
        return df.sparkSession.createDataFrame([], PROFIT_REPORT)
    voted = _forest_predictions(split, key, columns, stage, "profit", math.ceil(math.sqrt(len(columns))), settings)
    share = F.round("value", 12)  # equal votes are equal, whatever order they were added in
    fitted = {"RandomForest": voted.select("target", share.alias("rawPrediction"), (share > 0.5).cast("double").alias("prediction"))}
    fitted |= _fit_all(split, columns, {
        # the unscaled penalty of one unit of inverse strength
        "LogisticRegression": LogisticRegression(
            labelCol="target", maxIter=500, regParam=1.0 / max(n_train, 1), standardization=False
        ),
    })
    results = []
    for name, predicted in fitted.items():
        hit, guess = F.col("target") == 1, F.col("prediction") == 1
        m = predicted.agg(
            F.avg((F.col("target") == F.col("prediction")).cast("int")).alias("accuracy"),
            F.count_if(hit & guess).alias("tp"),
            F.count_if(guess).alias("guessed"),
            F.count_if(hit).alias("actual"),
        ).first()
        auc = BinaryClassificationEvaluator(labelCol="target", metricName="areaUnderROC").evaluate(predicted)
        f1 = 2 * m.tp / (m.guessed + m.actual) if m.guessed + m.actual else 0.0
        results.append((name, round(m.accuracy, 4), round(f1, 4), round(auc, 4), n_train, n_test))
    return df.sparkSession.createDataFrame(
        results, PROFIT_REPORT
    ).orderBy(F.desc("roc_auc"), "model")


def revenue_models(
    df: DataFrame,
    key: str,
    stage,
    target: str = "log_revenue",
    features: Sequence[str] = REVENUE_FEATURES,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Random forest, gradient boosting and ridge on a log target; no rows below the minimum number of rows."""
    split, columns, _ = split_features(df, key, target, features, stage, "revenue", settings)
    n_train, n_test = _sizes(split)
    if n_train + n_test < settings.min_model_rows:
        return df.sparkSession.createDataFrame([], REVENUE_REPORT)
    voted = _forest_predictions(split, key, columns, stage, "revenue", math.ceil(len(columns) / 3), settings)
    fitted = {"RandomForestRegressor": voted.withColumnRenamed("value", "prediction")}
    fitted |= _fit_all(split, columns, {
        "GradientBoosting": GBTRegressor(
            labelCol="target", maxIter=100, maxDepth=3, stepSize=0.1, seed=settings.seed
        ),
        "Ridge": LinearRegression(
            labelCol="target", elasticNetParam=0.0, regParam=1.0 / max(n_train, 1), standardization=False
        ),
    })
    results = []
    for name, predicted in fitted.items():
        r2 = RegressionEvaluator(labelCol="target", metricName="r2").evaluate(predicted)
        mae = RegressionEvaluator(labelCol="target", metricName="mae").evaluate(predicted)
        results.append((name, round(r2, 4), round(mae, 4), n_train, n_test))
    return df.sparkSession.createDataFrame(
        results, REVENUE_REPORT
    ).orderBy(F.desc("r2"), "model")


def revenue_input(master: DataFrame) -> DataFrame:
    """Master rows with both amounts, on the log scale the regression works on."""
    both = master.where(F.col("revenue_usd").isNotNull() & F.col("budget_usd").isNotNull())
    return both.withColumns({"log_revenue": F.log1p("revenue_usd"), "log_budget": F.log1p("budget_usd")})
