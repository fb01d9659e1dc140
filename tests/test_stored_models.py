"""Trees scored by joins, the penalised optimum, stored fits and bucketed joins."""

import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from veloframe.operators import encode, learn, optimality, relational, rules
from veloframe.plans import jobs
from veloframe.plans.fitted import fit_trips, load_fitted
from veloframe.sources import bucketed
from veloframe.sources import fixtures as fx
from veloframe.sources.catalog import shared_path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- vector entries and rule tables --------------------------------------------

def test_entries_of_dense_and_sparse_vectors(spark):
    vectors = [Vectors.dense([0.0, 1.5, -2e-9]), Vectors.sparse(6, [1, 4], [0.1, 3.0]), Vectors.sparse(5, [], []),
               Vectors.dense([0.0]), Vectors.sparse(3, [0, 2], [0.0, 1e300]), Vectors.dense([])]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], ["k", "v"])
    for r in df.select("k", encode.entries("v").alias("e")).collect():
        want = {i: x for i, x in enumerate(vectors[r.k].toArray().tolist()) if x != 0}
        assert {e["index"]: e["value"] for e in r.e} == want


@pytest.fixture(scope="module")
def points(spark):
    r = random.Random(5)
    rows = []
    for i in range(900):
        c, x, s = r.randrange(7), round(r.random(), 2), r.randrange(20)
        label = float((c in (1, 4, 5)) + (x > 0.6) if r.random() < 0.85 else r.randrange(3))
        rows.append((i, float(c), x, Vectors.sparse(20, [s], [1.0]), label))
    df = spark.createDataFrame(rows, ["id", "c", "x", "s", "label"])
    meta = {"ml_attr": {"type": "nominal", "num_vals": 7, "name": "c"}}
    df = encode.assemble(df.withColumn("c", F.col("c").alias("c", metadata=meta)), ["c", "x", "s"])
    return df.select("id", "features", "label").cache()


@pytest.mark.parametrize("make, settings", [(learn.decision_tree, {"max_depth": 9}), (learn.decision_tree, {"max_depth": 0}),
                                            (learn.random_forest, {"max_depth": 6, "numTrees": 7})])
def test_rules_equal_the_model_by_row(points, make, settings):
    model = make(**settings).fit(points)
    own = {r.id: r.prediction for r in model.transform(points).collect()}
    got = {r.id: r.prediction for r in rules.score_by_model_rules(points, model, "id").collect()}
    assert got == own


def test_rule_table_holds_the_whole_tree(spark, points):
    model = learn.decision_tree(max_depth=9).fit(points)
    table = rules.rule_table(spark, model)
    assert table.count() == model.numNodes and rules.depth_of(table) == model.depth
    inner = table.where(F.col("left").isNotNull())
    assert inner.where(F.col("categories").isNotNull()).where("feature <> 0").count() == 0
    assert inner.where(F.col("categories").isNull() & F.col("threshold").isNull()).count() == 0


def test_rules_by_shuffle_and_in_one_pass(spark, points):
    model = learn.random_forest(max_depth=4, numTrees=3).fit(points)
    table = rules.rule_table(spark, model)
    args = (points, table, rules.depth_of(table), 3, model.numClasses, "id")
    wide = rules.score_by_rules(*args, max_broadcast_bytes=0)
    one = rules.score_by_rules(*args)
    plan = plan_of(one)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, wide.collect()))
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


# --- penalised optimum -----------------------------------------------------------

@pytest.fixture(scope="module")
def two_classes(spark):
    r = random.Random(9)
    rows = []
    for _ in range(800):
        x = [r.gauss(0, 3), r.gauss(5, 0.2), float(r.random() < 0.3), 4.0]
        rows.append((Vectors.dense(x), float(r.random() < 1 / (1 + 2.718281828 ** -(0.9 * x[0] - 6 * (x[1] - 5) + x[2])))))
    return spark.createDataFrame(rows, ["features", "label"]).cache()


@pytest.mark.parametrize("lam, alpha", [(0.3, 0.8), (0.05, 0.5), (0.02, 0.0), (0.01, 1.0), (0.0, 0.0)])
def test_converged_fits_meet_the_conditions(two_classes, lam, alpha):
    model = LogisticRegression(maxIter=300, tol=1e-10, regParam=lam, elasticNetParam=alpha).fit(two_classes)
    r = optimality.penalty_report(two_classes, model, 1e-4).first()
    assert r.optimal == 1 and (r.active > 0 or lam == 0.3)


def test_other_fits_do_not(two_classes):
    """A constant predictor, too few steps, and another penalty's optimum."""
    settings = dict(regParam=0.05, elasticNetParam=0.5)
    good = LogisticRegression(maxIter=300, tol=1e-10, **settings).fit(two_classes)
    constant = LogisticRegression(maxIter=100, regParam=50.0, elasticNetParam=1.0).fit(two_classes)
    other = LogisticRegression(maxIter=300, regParam=0.1, elasticNetParam=0.5).fit(two_classes)
    early = LogisticRegression(maxIter=1, **settings).fit(two_classes)
    assert constant.coefficients.numNonzeros() == 0
    for model in (constant, other, early):
        model.set(model.regParam, 0.05)
        model.set(model.elasticNetParam, 0.5)
        assert optimality.penalty_report(two_classes, model).first().optimal == 0
    assert optimality.penalty_report(two_classes, good).first().optimal == 1


def test_gradient_is_grouped_and_rows_stay_put(two_classes):
    model = LogisticRegression(maxIter=5).fit(two_classes)
    plan = plan_of(optimality.gradient_sums(model.transform(two_classes)))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan


# --- stored fits -------------------------------------------------------------------

def test_stored_fit_scores_unseen_trips(spark, small_dir):
    first, second = fx.trip_halves(fx.trips(spark, small_dir, "by_day"))
    fitted = fit_trips(first)
    path = shared_path(spark, "test-fitted")
    fitted.save(path, overwrite=True)
    fitted.save(path, overwrite=True)
    again = load_fitted(spark.newSession(), path)
    assert again.model.coefficients == fitted.model.coefficients and again.inputs == fitted.inputs
    strange = second.withColumns({"start_station": F.lit("nowhere"), "zip": F.lit("never seen")})
    for trips in (second, strange, second.withColumn("zip", F.lit(None).cast("string")), second.limit(0)):
        got = sorted(map(tuple, load_fitted(spark, path).score(trips).collect()))
        assert got == sorted(map(tuple, fitted.score(trips).collect())) and len(got) == trips.count()
    day = {r.trip_id: r.sub_type for r in second.collect()}
    assert all(day[r.trip_id] == r.predicted for r in again.score(fx.trip_halves(
        fx.trips(spark.newSession(), small_dir, "by_day"))[1]).collect())


def test_scoring_needs_no_fit_and_no_label(spark, small_dir):
    trips = fx.trips(spark, small_dir, "by_day")
    fitted = fit_trips(trips)
    assert fitted.score(trips.drop("sub_type")).columns == ["trip_id", "prediction", "probability", "predicted"]


# --- bucketed join --------------------------------------------------------------------

def stations(spark, n=3000):
    rows = [(i, "HOT" if i % 3 == 0 else (None if i % 97 == 0 else f"S{i % 40}"), i * 7) for i in range(n)]
    return spark.createDataFrame(rows, "trip_id long, start_station string, extra int").repartition(5)


@pytest.mark.parametrize("per_task", [100, 10 ** 6])
def test_bucketed_join_without_exchange(spark, per_task):
    trips = stations(spark)
    side = trips.groupBy("start_station").agg(F.count(F.lit(1)).alias("w"), F.avg("trip_id").alias("a"))
    side = side.where("start_station is null or start_station <> 'S7'")
    names = (f"bucket_rows_{per_task}", f"bucket_side_{per_task}")
    pair = bucketed.save_bucketed_pair(trips, side, "start_station", "w", names, 8, mode="overwrite", rows_per_task=per_task)
    got = bucketed.join_bucketed(spark, pair)
    plan = plan_of(got)
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "SelectedBucketsCount: 8 out of 8" in plan
    want = trips.join(F.broadcast(side.drop("w")), "start_station", "left")
    columns = ["trip_id", "start_station", "extra", "a"]
    assert sorted(map(repr, got.select(columns).collect())) == sorted(map(repr, want.select(columns).collect()))
    sizes = [r["n"] for r in spark.table(names[0]).groupBy("start_station", bucketed.SALT).agg(F.count(F.lit(1)).alias("n")).collect()]
    if per_task == 100:
        assert max(sizes) < 250  # the hot station has 1000 rows over 10 salts
    files = {f.rsplit("_", 1)[1] for f in spark.table(names[0]).inputFiles()}
    assert len(files) == len(spark.table(names[0]).inputFiles())  # one file per bucket


def test_bucketed_names_that_clash(spark):
    with pytest.raises(ValueError):
        bucketed.save_bucketed_pair(stations(spark, 9).withColumn("__salt", F.lit(1)), stations(spark, 9), "start_station",
                                    "extra", ("x", "y"), 4)


# --- random split ----------------------------------------------------------------------

def test_random_split_by_key_is_a_draw_of_the_key(spark):
    import hashlib

    ids = spark.range(2000).withColumnRenamed("id", "trip_id")
    train, valid = encode.split_random(ids.repartition(7), (0.8, 0.2), 5, "trip_id")
    want = {i for i in range(2000) if int(hashlib.md5(f"5:{i}".encode()).hexdigest()[:8], 16) / 2 ** 32 < 0.8}
    assert {r.trip_id for r in train.collect()} == want
    assert {r.trip_id for r in valid.collect()} == set(range(2000)) - want
    thirds = encode.split_random(ids, (1, 1, 1), 5, "trip_id")
    assert sum(p.count() for p in thirds) == 2000 and all(550 < p.count() < 780 for p in thirds)


def test_window_job_writes_its_features(spark, small_dir):
    trips = fx.trips(spark, small_dir, "by_half")
    jobs.window_features_job(trips, models=("decision_tree",), table_name="window_features_test",
                             table_path=shared_path(spark, "window_features_test"))
    stored = spark.table("window_features_test")
    assert stored.count() == trips.count() and stored.columns == [*trips.columns, "average", "round_trip"]
    assert relational.group_count(stored.where("average is null"), "round_trip").count() == 0
