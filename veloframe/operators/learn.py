"""Classifiers and their quality figures.

The learners are ``pyspark.ml`` estimators (distributed tree aggregation
per iteration); metrics are DataFrame aggregates, so the scored rows never
leave the executors -- only the final numbers do.

A logistic regression with an L1 penalty over a wide vector is fitted on the features that can have a
coefficient at all. For a standardised feature (deviation s) the slope of the mean log loss is the mean of
residual * x / s, and no residual exceeds 1; so where the mean of abs(x) is at most regParam * elasticNet * s,
the slope stays within the penalty whatever the other coefficients are, and the optimum's coefficient is 0. The
optimum of the others is then that of all. So what the driver holds and each iteration sends is as wide as the
features that many rows share, not as all categories.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veloframe.operators.encode import MOST_NAMED, entries

# Learner settings of the trip jobs.
FOREST_MAX_DEPTH = 10
TREE_MAX_DEPTH = 20
LOGISTIC_MAX_ITER = 10
LOGISTIC_REG_PARAM = 0.3
LOGISTIC_ELASTIC_NET = 0.8


def random_forest(seed: int = 42, max_depth: int = FOREST_MAX_DEPTH, **kw) -> RandomForestClassifier:
    """M6: random forest (20 trees by default)."""
    return RandomForestClassifier(maxDepth=max_depth, seed=seed, **kw)


def decision_tree(seed: int = 42, max_depth: int = TREE_MAX_DEPTH, **kw) -> DecisionTreeClassifier:
    """M7: one decision tree."""
    return DecisionTreeClassifier(maxDepth=max_depth, seed=seed, **kw)


def logistic_regression(max_iter: int = LOGISTIC_MAX_ITER, reg_param: float = LOGISTIC_REG_PARAM,
                        elastic_net: float = LOGISTIC_ELASTIC_NET, **kw) -> LogisticRegression:
    """M8: elastic-net logistic regression."""
    return LogisticRegression(maxIter=max_iter, regParam=reg_param,
                              elasticNetParam=elastic_net, **kw)


def fit_and_score(estimator, train: DataFrame, valid: DataFrame) -> DataFrame:
    """M9: fit on ``train``; the scored validation rows (rawPrediction,
    probability, prediction appended to features, label)."""
    if isinstance(estimator, LogisticRegression):
        return scored_by(*fit_logistic(estimator, train), valid)
    return estimator.fit(train).transform(valid)


#: The vector of the features that a fit keeps.
KEPT = "__kept"


def kept_features(estimator: LogisticRegression, train: DataFrame) -> list[int] | None:
    """Numbers of the features whose coefficient the penalty does not hold at 0 (the first, where there are
    none); None where all are taken: narrow vectors, no L1 penalty or one on raw coefficients. Otherwise one
    grouped sum over the rows' entries."""
    features = estimator.getFeaturesCol()
    width = train.schema[features].metadata.get("ml_attr", {}).get("num_attrs") or 0
    bound = estimator.getRegParam() * estimator.getElasticNetParam()
    if width <= MOST_NAMED or bound == 0 or not estimator.getStandardization():
        return None
    rows = F.struct(F.lit(-1).alias("index"), F.lit(1.0).alias("value"))
    x = F.col("e.value")
    sums = train.select(F.explode(F.concat(entries(features), F.array(rows))).alias("e")).groupBy(
        F.col("e.index").alias("feature")).agg(
        F.sum(F.abs(x)).alias("sizes"), F.sum(x).alias("values"), F.sum(x * x).alias("squares"))
    n = float(train.count())
    deviation = F.sqrt(F.greatest(F.lit(0.0), (F.col("squares") - F.col("values") ** 2 / n) / (n - 1)))
    held = F.col("sizes") / n <= bound * deviation * (1 - 1e-9)
    found = sums.where((F.col("feature") >= 0) & ~F.coalesce(held, F.lit(False))).select("feature").collect()
    kept = sorted(r["feature"] for r in found) or [0]
    return kept if len(kept) < width else None


def _narrowed(df: DataFrame, features: str, kept: Sequence[int]) -> DataFrame:
    return VectorSlicer(inputCol=features, outputCol=KEPT, indices=list(kept)).transform(df)


def fit_logistic(estimator: LogisticRegression, train: DataFrame) -> tuple[LogisticRegressionModel, list[int] | None]:
    """The model and the features that it is of (None: all)."""
    kept = kept_features(estimator, train)
    if kept is None:
        return estimator.fit(train), None
    features, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    narrow = _narrowed(train.select(features, label), features, kept).select(F.col(KEPT).alias(features), label)
    return estimator.fit(narrow), kept


def scored_by(model: LogisticRegressionModel, kept: Sequence[int] | None, df: DataFrame) -> DataFrame:
    """``df`` scored by a model of the features ``kept``."""
    if kept is None:
        return model.transform(df)
    own = model.copy({model.getParam("featuresCol"): KEPT})
    return own.transform(_narrowed(df, model.getFeaturesCol(), kept)).drop(KEPT)


def accuracy_frame(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M10-M12 as one aggregate row: n, accuracy (share of exact hits), test_error."""
    hit = (F.col(prediction) == F.col(label)).cast("double")
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy")).withColumn(
        "test_error", F.lit(1.0) - F.col("accuracy"))


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    """The evaluator's accuracy (a number on the driver)."""
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                           metricName="accuracy")
    return float(ev.evaluate(scored))
