"""A decision tree over wide one-hot vectors, grown by grouped sums of their entries.

``pyspark.ml``'s tree learner holds a number per feature and row, so with a category per customer its work is
rows times categories. Here a row is its label and the list of features that are 1. Each level takes one
grouped sum over (node, feature, label) of those entries; a feature's absent side is the node's total less its
present side, so the work is that of the entries. The split of a node is that of greatest Gini gain over all
features, ties to the smaller feature, as in ``pyspark.ml`` for features of two values; a node without gain, of
one class or at the greatest depth is a leaf. Nodes that are still open take their rows to the next level.

The result is a rule table (``operators.rules``): root 0, children 2n + 1 (absent) and 2n + 2 (present).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veloframe.operators import rules
from veloframe.operators.encode import entries
from veloframe.operators.relational import sized_side
from veloframe.sources.catalog import cut_lineage, drop_files

#: The feature number under which a node's own totals are counted.
TOTAL = -1


def present(features: str) -> Column:
    """The features that are 1; any value other than 0 and 1 fails the job."""
    return F.transform(entries(features), lambda e: F.when(e["value"] == 1, e["index"]).otherwise(
        F.raise_error(F.lit("an indicator is neither 0 nor 1")).cast("int")))


def rows_of(counts: Column) -> Column:
    return F.reduce(counts, F.lit(0.0), lambda a, c: a + c)


def gini(counts: Column) -> Column:
    n = rows_of(counts)
    return F.reduce(counts, F.lit(1.0), lambda a, c: a - (c / n) * (c / n))


def _open(counts: Column) -> Column:
    """Whether rows of more than one class are there."""
    return F.size(F.filter(counts, lambda c: c > 0)) > 1


def _splits(level: DataFrame, classes: int) -> DataFrame:
    """(node, feature, total, present): the best split of each node that has one with a gain."""
    cells = (level.select("node", "label", F.explode(F.concat("present", F.array(F.lit(TOTAL)))).alias("feature"))
             .groupBy("node", "feature").agg(*[F.count_if(F.col("label") == c).alias(f"n{c}") for c in range(classes)]))
    cells = cut_lineage(cells.select("node", "feature", F.array(
        *[F.col(f"n{c}").cast("double") for c in range(classes)]).alias("counts")), "tree-cells")
    totals = cells.where(F.col("feature") == TOTAL).select("node", F.col("counts").alias("total"))
    both = cells.where(F.col("feature") != TOTAL).join(totals, "node")
    absent = F.zip_with("total", "counts", lambda t, c: t - c)
    n, right = rows_of(F.col("total")), rows_of(F.col("counts"))
    parts = (n - right) / n * gini(absent) + right / n * gini(F.col("counts"))
    both = both.where((right > 0) & (right < n)).withColumn("gain", gini(F.col("total")) - parts)
    best = both.where(F.col("gain") > 0).groupBy("node").agg(F.max_by(
        F.struct("feature", "total", F.col("counts").alias("present")), F.struct("gain", -F.col("feature"))).alias("best"))
    out = cut_lineage(best.select("node", "best.*"), "tree-splits")
    drop_files(cells)
    return out


def grow(train: DataFrame, max_depth: int, features: str = "features", label: str = "label") -> tuple[DataFrame, int, int]:
    """The rule table of a tree, its depth and the number of classes. Three or four jobs run for each level."""
    spark = train.sparkSession
    level = cut_lineage(train.select(F.col(label).alias("label"), present(features).alias("present"),
                                     F.lit(0).cast("long").alias("node")), "tree-rows")
    found = {int(r["label"]): float(r["n"]) for r in level.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = max(found, default=0) + 1
    counts = [found.get(c, 0.0) for c in range(classes)]
    nodes = spark.createDataFrame([(0, counts)], "node long, counts array<double>")
    tables, depth, more = [], 0, len(found) > 1
    while more and depth < max_depth:
        splits = _splits(level, classes)
        if splits.isEmpty():
            break
        tables.append(nodes.join(splits.select("node", "feature"), "node", "left"))
        absent = F.zip_with("total", "present", lambda t, c: t - c)
        nodes = cut_lineage(splits.select(F.explode(F.array(
            F.struct((F.col("node") * 2 + 1).alias("node"), absent.alias("counts")),
            F.struct((F.col("node") * 2 + 2).alias("node"), F.col("present").alias("counts")))).alias("c")).select("c.*"),
            "tree-nodes")
        depth += 1
        more = depth < max_depth and not nodes.where(_open(F.col("counts"))).isEmpty()
        if more:
            side, _ = sized_side(splits.select("node", "feature", _open(absent).alias("absent_open"),
                                               _open(F.col("present")).alias("present_open")))
            on = F.array_contains("present", F.col("feature"))
            moved = level.join(side, "node").where(F.when(on, F.col("present_open")).otherwise(F.col("absent_open")))
            last, level = level, cut_lineage(moved.select(
                "label", "present", (F.col("node") * 2 + F.when(on, 2).otherwise(1)).alias("node")), "tree-rows")
            drop_files(last)
    drop_files(level)
    tables.append(nodes.withColumn("feature", F.lit(None).cast("int")))
    whole = tables[0]
    for t in tables[1:]:
        whole = whole.unionByName(t)
    inner = F.col("feature").isNotNull()
    table = whole.select(
        F.lit(0).alias("tree"), "node", "feature", F.when(inner, F.lit(0.5)).alias("threshold"),
        F.lit(None).cast("array<double>").alias("categories"), F.when(inner, F.col("node") * 2 + 1).alias("left"),
        F.when(inner, F.col("node") * 2 + 2).alias("right"), "counts")
    return cut_lineage(table, "tree"), depth, classes


def fit_and_score(train: DataFrame, valid: DataFrame, max_depth: int, features: str = "features") -> DataFrame:
    """``valid`` with the prediction of a tree grown on ``train``; rows that are alike stay as many."""
    table, depth, classes = grow(train, max_depth, features)
    rows = valid.select(F.struct(*[c for c in valid.columns if c != features]).alias("__row"), features)
    scored = rules.score_by_rules(rows, table, depth, 1, classes, "__row", features)
    return scored.select("__row.*", "prediction")
