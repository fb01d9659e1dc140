"""Trees as rows: a fitted tree or forest exported as a rule table and scored by joins.

``rule_table`` has a row per node: the feature and threshold (or the categories that go left), the two
children, and the node's class counts. ``score_by_rules`` walks all trees a level at a time: the rows, once
per tree, are joined to the node that each stands at and move on to a child. The rule table is measured and
broadcast within the usual bound, so all levels run in one pass over the rows; a larger one is joined by
shuffle. Votes of a forest are added in the order of its trees, as the model does, so that both agree to the
last bit.
"""

from __future__ import annotations

import uuid

from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.operators.encode import entries
from veloframe.operators.relational import sized_side
from veloframe.sources.catalog import shared_path

TreeModel = DecisionTreeClassificationModel | RandomForestClassificationModel


def rule_table(spark: SparkSession, model: TreeModel) -> DataFrame:
    """(tree, node, feature, threshold, categories, left, right, counts); leaves have no feature and no
    children. ``x <= threshold``, or a category of the list, goes left. The model's own stored form is
    read, so its nodes do not pass through Python."""
    path = shared_path(spark, f"model-{uuid.uuid4().hex}")
    model.write().save(path)
    stored = spark.read.parquet(f"{path}/data")
    nodes = (stored.select(F.col("treeID").alias("tree"), "nodeData.*") if "nodeData" in stored.columns
             else stored.withColumn("tree", F.lit(0)))
    inner, by_category = F.col("leftChild") >= 0, F.col("split.numCategories") >= 0
    values = F.col("split.leftCategoriesOrThreshold")
    return nodes.select(
        "tree", F.col("id").alias("node"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & ~by_category, F.get(values, 0)).alias("threshold"),
        F.when(inner & by_category, values).alias("categories"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.col("impurityStats").alias("counts"))


def depth_of(rules: DataFrame) -> int:
    """Levels below the root; by one small job per level."""
    at = rules.where(F.col("node") == 0).select("tree", "node")
    depth = -1
    while not at.isEmpty():
        depth += 1
        step = at.join(rules, ["tree", "node"]).where(F.col("left").isNotNull())
        at = step.select("tree", F.explode(F.array("left", "right")).alias("node"))
    return depth


def votes(trees: Column, classes: int) -> Column:
    """Sum over the trees, in order, of each leaf's class shares; a leaf without rows has no vote."""
    zero = F.array_repeat(F.lit(0.0), classes)

    def add(total: Column, one: Column) -> Column:
        size = F.reduce(one["counts"], F.lit(0.0), lambda a, b: a + b)
        return F.zip_with(total, one["counts"], lambda t, c: F.when(size != 0, t + c / size).otherwise(t))

    return F.reduce(F.array_sort(trees), zero, add)


def first_greatest(values: Column) -> Column:
    """Number of the first greatest value, as a double."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("double")


def score_by_rules(df: DataFrame, rules: DataFrame, depth: int, trees: int, classes: int, key: str,
                   features: str = "features", out: str = "prediction",
                   max_broadcast_bytes: int | None = None) -> DataFrame:
    """``key`` and the class that the rules give to each row; ``key`` must be unique."""
    side, _ = sized_side(rules.select(
        F.col("tree").alias("__tree"), F.col("node").alias("__at"), "feature", "threshold", "categories",
        "left", "right", "counts"), max_broadcast_bytes)
    inner, leaves = side.drop("counts"), side.select("__tree", "__at", "counts")
    at = df.select(F.col(key), F.map_from_entries(entries(features)).alias("__x"),
                   F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    meets = (F.col("tree") == F.col("__tree")) & (F.col("node") == F.col("__at"))
    value = F.coalesce(F.try_element_at("__x", F.col("feature")), F.lit(0.0))
    goes_left = F.coalesce(value <= F.col("threshold"), F.array_contains("categories", value))
    for _ in range(depth):
        step = F.when(F.col("left").isNull(), F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = at.join(inner, meets).select(key, "__x", "tree", step.alias("node"))
    ended = at.join(leaves, meets)
    if trees == 1:
        return ended.select(key, first_greatest(F.col("counts")).alias(out))
    cast = ended.groupBy(key).agg(F.collect_list(F.struct("tree", "counts")).alias("trees"))
    return cast.select(key, first_greatest(votes(F.col("trees"), classes)).alias(out))


def score_by_model_rules(df: DataFrame, model: TreeModel, key: str, features: str = "features") -> DataFrame:
    """``score_by_rules`` with the model's own rule table."""
    trees = model.getNumTrees if isinstance(model, RandomForestClassificationModel) else 1
    rules = rule_table(df.sparkSession, model)
    return score_by_rules(df, rules, depth_of(rules), trees, model.numClasses, key, features)
