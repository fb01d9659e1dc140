"""Feature operators and the console-transcript invariants."""

import datetime

from pyspark.sql import functions as F

from veloframe.operators import features as feat
from veloframe.plans.queries import flagship_trip_features, trips_per_weekday
from veloframe.sources import fixtures as fx


def test_weekday_numbering_and_class(spark):
    days = [datetime.datetime(2014, 8, 31, 10), datetime.datetime(2014, 8, 30, 10),
            datetime.datetime(2014, 8, 29, 10), None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, ts timestamp_ntz")
    got = [(r.start_day, r.start_dow) for r in
           feat.with_day_of_week(df, "ts").orderBy("i").collect()]
    assert got == [(6, "weekend"), (5, "weekend"), (4, "weekday"), (None, None)]


def test_round_trip_flag(spark):
    df = spark.createDataFrame([("A", "A"), ("A", "B"), (None, None), (None, "B")], "s string, e string")
    assert [r.round_trip for r in feat.with_equal_flag(df, "s", "e").collect()] == [1, 0, 1, 0]


def test_days_between_ignores_time(spark):
    df = spark.createDataFrame([(datetime.datetime(2014, 1, 1, 23, 59), datetime.datetime(2014, 1, 2, 0, 1),
                                 99)], "s timestamp_ntz, e timestamp_ntz, duration int")
    assert feat.with_days_between(df, "e", "s").first().duration == 1


def test_group_average_window_semantics(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, "a", None), (3, "a", 20), (4, None, 7), (5, None, 9)],
                               "id int, k string, d int")
    got = {r.id: r.average for r in feat.with_group_average(df, "k", "d").collect()}
    assert got == {1: 15.0, 2: 15.0, 3: 15.0, 4: 8.0, 5: 8.0}


def test_station_features_equal_separate_operators(spark, small_dir):
    t = feat.with_day_of_week(fx.trips(spark, small_dir, "nulls"), "start_date")
    combined = feat.with_station_features(t)
    separate = feat.with_group_shares(feat.with_group_average(t, "start_station", "duration"))
    cols = ["trip_id", "average", "pct_weekday", "pct_weekend"]
    assert sorted(combined.select(cols).collect()) == sorted(separate.select(cols).collect())


def test_flagship_invariants(spark, small_dir):
    df = flagship_trip_features(spark, small_dir)
    base = fx.trips(spark, small_dir)
    # append-only columns
    assert df.columns[:len(base.columns)] == base.columns
    assert df.columns[len(base.columns):] == ["average", "round_trip", "start_day", "start_dow",
                                              "pct_weekday", "pct_weekend"]
    # average constant within a start station
    assert df.groupBy("start_station").agg(F.countDistinct("average").alias("k")).where("k > 1").count() == 0
    # weekday counts add up to the table
    per_day = trips_per_weekday(spark, small_dir).collect()
    assert sum(r.n for r in per_day) == base.count()
    assert [r.start_day for r in per_day] == sorted(r.start_day for r in per_day)


def test_flagship_plan_has_no_python_and_no_big_shuffle(spark, small_dir):
    df = flagship_trip_features(spark, small_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
