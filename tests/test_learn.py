"""Learners and metrics; the scored frame's shape."""

from veloframe.operators import learn
from veloframe.plans import jobs
from veloframe.plans.queries import job_all_features, job_baseline, rf_accuracy
from veloframe.sources import fixtures as fx


def test_accuracy_frame(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (0.0, 0.0), (1.0, 1.0)], "label double, prediction double")
    r = learn.accuracy_frame(df).first()
    assert (r.n, r.accuracy, r.test_error) == (4, 0.75, 0.25)
    assert learn.accuracy(df) == 0.75


def test_scored_frame_columns(spark, small_dir):
    points = jobs.all_features_points(fx.trips(spark, small_dir)).drop("trip_id")
    train, valid = points.randomSplit([0.8, 0.2], seed=1)
    scored = learn.fit_and_score(learn.logistic_regression(), train, valid)
    assert scored.columns == ["features", "label", "rawPrediction", "probability", "prediction"]
    assert points.first().features.size == points.schema["features"].metadata["ml_attr"]["num_attrs"]


def test_jobs_give_accuracies(spark, small_dir):
    for df in (job_baseline(spark, small_dir), job_all_features(spark, small_dir), rf_accuracy(spark, small_dir)):
        for r in df.collect():
            assert 0.0 <= r.accuracy <= 1.0
            assert abs(r.accuracy + r.test_error - 1.0) < 1e-12


def test_hash_split_job(spark, small_dir):
    out = jobs.baseline_job(fx.trips(spark, small_dir), models=("decision_tree",), split="hash")
    r = out.first()
    assert r.model == "decision_tree" and 0.0 <= r.accuracy <= 1.0


def test_figures_do_not_depend_on_the_partitioning(spark, small_dir):
    trips = fx.trips(spark, small_dir)
    for split in ("hash", "random"):
        got = [[tuple(r) for r in jobs.baseline_job(trips.repartition(n, "zip"), models=("random_forest", "decision_tree"),
                                                    split=split).collect()] for n in (2, 7)]
        assert got[0] == got[1]


def test_nothing_stays_persisted(spark, small_dir):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for split in ("hash", "random"):
        jobs.baseline_job(fx.trips(spark, small_dir), models=("decision_tree",), split=split).collect()
    job_all_features(spark, small_dir).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_constant_predictor_fails_the_scored_query(spark, small_dir):
    from veloframe.plans.queries import lr_scored

    rows = lr_scored(spark, small_dir).collect()
    assert rows and all(r.prediction == r.label and r.above_half == 1 for r in rows)
    assert len({r.label for r in rows}) == 2  # so that any constant prediction is wrong somewhere


def test_station_model_has_coefficients(spark, small_dir):
    points = jobs.station_points(fx.trips(spark, small_dir, "by_terminal")).drop("trip_id")
    model = learn.logistic_regression(reg_param=0.0, elastic_net=0.0).fit(points)
    assert sum(abs(c) > 1e-6 for c in model.coefficients.toArray()) > 10


def test_labels_of_the_train_part(spark, small_dir):
    trips = fx.trips(spark, small_dir, "blanks").where("sub_type is not null and zip <> ''")
    row = jobs.all_features_job([trips], models=("decision_tree",), fit_on="train").first()
    assert 0.0 <= row.accuracy <= 1.0


def test_window_job_joins_only_what_it_reads(spark, small_dir):
    from veloframe.plans.jobs import _numeric_points

    plan = _numeric_points(fx.trips(spark, small_dir), "trip_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 3
