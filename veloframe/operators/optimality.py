"""Whether a logistic regression with elastic-net penalty is at its optimum.

For standardised coefficients b (each coefficient times its feature's deviation) the fit minimises

    mean log loss + regParam * (elasticNet * |b|_1 + (1 - elasticNet) / 2 * |b|_2^2).

At the optimum the gradient of the mean log loss in b_j equals -regParam * (elasticNet * sign(b_j) +
(1 - elasticNet) * b_j) where b_j is not 0, lies within regParam * elasticNet of 0 where it is, and the
residuals' mean is 0. ``penalty_gaps`` computes the gradient as one grouped sum over the non-zero entries of
the training rows and gives how far each feature is from these conditions; a constant predictor fails them
wherever some feature's gradient exceeds the bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veloframe.operators.encode import entries
from veloframe.operators.learn import scored_by
from veloframe.sources.catalog import cut_lineage


def gradient_sums(scored: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """(feature, residuals, values, squares): per feature the sums of residual * value, value and value
    squared, over the rows' non-zero entries; feature -1 has the residuals' sum and the number of rows."""
    residual = F.get(vector_to_array("probability"), 1) - F.col(label)
    bias = F.struct(F.lit(-1).alias("index"), F.lit(1.0).alias("value"))
    cells = scored.select(residual.alias("r"), F.explode(F.concat(entries(features), F.array(bias))).alias("e"))
    x = F.col("e.value")
    return cells.groupBy(F.col("e.index").alias("feature")).agg(
        F.sum(F.col("r") * x).alias("residuals"), F.sum(x).alias("values"), F.sum(x * x).alias("squares"))


def penalty_gaps(train: DataFrame, model: LogisticRegressionModel, features: str = "features",
                 label: str = "label", kept: Sequence[int] | None = None) -> DataFrame:
    """(feature, coefficient, gap) of a fitted two-class model over its training rows; feature -1 is the
    intercept. Features that are constant in the rows carry no penalty and are left out. For a model of the
    features ``kept`` alone, all others are held to the conditions with coefficient 0."""
    if model.numClasses != 2:
        raise ValueError("the conditions are those of two classes")
    spark = train.sparkSession
    lam, alpha = model.getRegParam(), model.getElasticNetParam()
    sums = cut_lineage(gradient_sums(scored_by(model, kept, train), features, label), "gradient")
    n = sums.where(F.col("feature") == -1).select(F.col("values").alias("n"))
    beta = spark.createDataFrame(
        [(int(kept[i]) if kept else int(i), float(v)) for i, v in zip(*_nonzero(model.coefficients), strict=True)],
        "feature int, coefficient double")
    rows = (sums.join(beta, "feature", "left").fillna(0.0, ["coefficient"])
            .join(F.broadcast(n.withColumn("one", F.lit(1))), F.lit(1) == F.col("one")))
    deviation = F.sqrt(F.greatest(F.lit(0.0), (F.col("squares") - F.col("values") ** 2 / F.col("n")) / (F.col("n") - 1)))
    own = F.col("feature") == -1
    rows = rows.withColumn("deviation", F.when(own, 1.0).otherwise(deviation)).where(F.col("deviation") > 1e-12)
    slope = F.col("residuals") / F.col("n") / F.col("deviation")
    b = F.col("coefficient") * F.col("deviation")
    gap = (F.when(own, F.abs(slope))
           .when(b != 0, F.abs(slope + lam * ((1 - alpha) * b + alpha * F.signum(b))))
           .otherwise(F.greatest(F.lit(0.0), F.abs(slope) - lam * alpha)))
    return rows.select("feature", "coefficient", gap.alias("gap"))


def _nonzero(vector) -> tuple[list, list]:
    dense = vector.toArray()
    at = dense.nonzero()[0]
    return at.tolist(), dense[at].tolist()


def penalty_report(train: DataFrame, model: LogisticRegressionModel, tolerance: float = 1e-3,
                   kept: Sequence[int] | None = None) -> DataFrame:
    """One row: rows, non-zero coefficients, the widest gap, and whether it is within ``tolerance``."""
    gaps = penalty_gaps(train, model, kept=kept)
    found = gaps.agg(F.count_if((F.col("feature") >= 0) & (F.col("coefficient") != 0)).alias("active"),
                     F.max("gap").alias("gap"))
    return found.select("active", "gap", (F.col("gap") <= tolerance).cast("int").alias("optimal"))
