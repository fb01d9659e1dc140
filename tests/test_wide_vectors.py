"""Learners over one-hot vectors of many categories: trees by entries, penalised fits of the features that count."""

import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from veloframe.operators import encode, indicator_tree, learn, optimality, rules

WIDTH = 1_500


@pytest.fixture(scope="module")
def wide(spark):
    """One of four common and one of many rare categories a row; three classes that mostly follow the common one."""
    r = random.Random(4)
    rows = []
    for i in range(1200):
        common, rare = r.randrange(4), 4 + r.randrange(WIDTH - 4)
        label = float(r.randrange(3) if r.random() < 0.1 else (common == 1) + 2 * (common == 3))
        rows.append((i // 2, Vectors.sparse(WIDTH, [common, rare], [1.0, 1.0]), label))
    df = spark.createDataFrame(rows, ["trip_id", "features", "label"])
    meta = {"ml_attr": {"num_attrs": WIDTH}}
    return df.withColumn("features", F.col("features").alias("features", metadata=meta)).cache()


def test_tree_equals_the_learner_of_dense_rows(spark):
    """On features of two values both find the same splits; ids that repeat keep each row."""
    r = random.Random(8)
    rows = []
    for i in range(600):
        on = [k for k in range(6) if r.random() < 0.4]
        label = float(2 * (0 in on and 3 not in on) + (5 in on) if r.random() < 0.9 else r.randrange(4))
        rows.append((i // 3, Vectors.sparse(6, on, [1.0] * len(on)), label))
    df = spark.createDataFrame(rows, ["trip_id", "features", "label"])
    for depth in (0, 1, 3, 6):
        own = learn.decision_tree(max_depth=depth).fit(df).transform(df)
        got = indicator_tree.fit_and_score(df, df, depth)
        columns = ["trip_id", "label", "prediction"]
        assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, own.select(columns).collect()))


def test_tree_finds_a_label_among_many_features(wide):
    table, depth, classes = indicator_tree.grow(wide, 4)
    assert classes == 3 and rules.depth_of(table) == depth <= 4
    root = table.where("node = 0").first()
    assert root.feature in (1, 3) and sum(root.counts) == 1200
    scored = indicator_tree.fit_and_score(wide, wide, 4)
    assert scored.columns == ["trip_id", "label", "prediction"] and scored.count() == 1200
    assert learn.accuracy_frame(scored).first().accuracy > 0.9


def test_tree_of_one_class_and_of_other_values(spark):
    one = spark.createDataFrame([(1, Vectors.sparse(3, [0], [1.0]), 0.0)], ["trip_id", "features", "label"])
    assert [r.prediction for r in indicator_tree.fit_and_score(one, one, 5).collect()] == [0.0]
    with pytest.raises(Exception, match="neither 0 nor 1"):
        other = spark.createDataFrame([(1, Vectors.sparse(3, [0], [2.0]), 0.0)], ["trip_id", "features", "label"])
        indicator_tree.grow(other, 5)


def test_penalised_fit_keeps_few_features_and_the_optimum_of_all(wide):
    two = wide.withColumn("label", (F.col("label") == 2).cast("double"))
    settings = dict(maxIter=200, tol=1e-10, regParam=0.1, elasticNetParam=0.8)
    model, kept = learn.fit_logistic(LogisticRegression(**settings), two)
    assert kept == [0, 1, 2, 3] and model.numFeatures == 4
    whole = LogisticRegression(**settings).fit(two)
    assert [i for i in range(WIDTH) if abs(whole.coefficients[i]) > 1e-6] == [
        kept[i] for i in range(4) if abs(model.coefficients[i]) > 1e-6]
    for at, i in enumerate(kept):
        assert abs(whole.coefficients[i] - model.coefficients[at]) < 1e-4
    assert optimality.penalty_report(two, model, 1e-4, kept).first().optimal == 1
    scored = learn.scored_by(model, kept, two)
    assert scored.columns == [*two.columns, "rawPrediction", "probability", "prediction"]
    same = whole.transform(two).groupBy("label", "prediction").count()
    assert sorted(map(tuple, scored.groupBy("label", "prediction").count().collect())) == sorted(map(tuple, same.collect()))


def test_fits_without_such_a_penalty_take_all_features(wide):
    for settings in (dict(regParam=0.0), dict(regParam=0.1, elasticNetParam=0.0),
                     dict(regParam=0.1, elasticNetParam=0.8, standardization=False)):
        assert learn.kept_features(LogisticRegression(**settings), wide) is None


def test_wide_vectors_carry_their_width_and_no_names(spark):
    rows = [(i, f"v{i}", "abc"[i % 3]) for i in range(encode.MOST_NAMED + 5)]
    df = spark.createDataFrame(rows, "id int, wide string, narrow string")
    hot = encode.one_hot(encode.index_columns(df, ["wide", "narrow"]), ["wide", "narrow"])
    out = encode.assemble(hot, ["wide", "narrow"])
    assert hot.schema["wide"].metadata == {"ml_attr": {"num_attrs": len(rows)}}
    assert len(hot.schema["narrow"].metadata["ml_attr"]["attrs"]["binary"]) == 3
    assert out.schema["features"].metadata == {"ml_attr": {"num_attrs": len(rows) + 3}}
    assert encode.vector_width(out) == out.first().features.size
    assert out.columns == ["id", "wide", "narrow", "features"]
