"""One station holding a third of all trips: results stay whole and equal to
the window definition, on the broadcast and on the shuffle-join path."""

import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from veloframe.operators import features as feat
from veloframe.operators import relational as rel


@pytest.fixture(scope="module")
def skewed(spark):
    base = datetime.datetime(2014, 8, 25)
    rows = []
    for i in range(3000):
        station = "HOT" if i % 3 == 0 else (None if i % 97 == 0 else f"S{i % 40}")
        rows.append((i, 60 + (i * 37) % 900, base + datetime.timedelta(hours=i), station))
    df = spark.createDataFrame(rows, "trip_id long, duration int, start_date timestamp_ntz, start_station string")
    return feat.with_day_of_week(df, "start_date").repartition(7)


def _window_truth(df):
    w = Window.partitionBy("start_station")
    wd = F.sum(F.when(F.col("start_dow") == "weekday", 1).otherwise(0)).over(w)
    we = F.sum(F.when(F.col("start_dow") == "weekend", 1).otherwise(0)).over(w)
    n = F.count(F.lit(1)).over(w)
    out = df.select("trip_id", "start_station", F.avg("duration").over(w).alias("average"),
                    wd.alias("w"), we.alias("e"), n.alias("n"))
    return {r.trip_id: (r.average,
                        None if r.start_station is None else round(r.w / r.n + 1e-12, 2),
                        None if r.start_station is None else round(r.e / r.n + 1e-12, 2))
            for r in out.collect()}


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_station_features_on_hot_key(spark, skewed, max_bytes, monkeypatch):
    if max_bytes == 0:  # force the shuffle-join path
        monkeypatch.setattr(rel, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(rel, "ROWS_PER_TASK", 100)
    got = feat.with_station_features(skewed).select("trip_id", "average", "pct_weekday", "pct_weekend")
    assert got.count() == 3000
    truth = _window_truth(skewed)
    for r in got.collect():
        avg, pw, pe = truth[r.trip_id]
        assert r.average == pytest.approx(avg, rel=1e-12)
        assert r.pct_weekday == pw and r.pct_weekend == pe


def test_group_average_has_no_window_and_no_hot_task(spark, skewed):
    df = feat.with_group_average(skewed, "start_station", "duration")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "BroadcastHashJoin" in plan


def test_salted_join_spreads_the_hot_key_without_adaptive_execution(spark, skewed):
    key_rows = skewed.groupBy("start_station").agg(F.count(F.lit(1)).alias("w"), F.avg("duration").alias("a"))
    side = key_rows.withColumnRenamed("start_station", "k")
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = rel.salted_join(skewed, side, F.col("start_station"), "k", "w", null_safe=True, rows_per_task=100)
        per_task = joined.where(F.col("start_station") == "HOT").groupBy(F.spark_partition_id()).count().collect()
        total = joined.count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    assert total == 3000
    hot = 1000
    assert len(per_task) >= 4 and max(r["count"] for r in per_task) < hot / 2
    got = {r.trip_id: r.a for r in joined.select("trip_id", "a").collect()}
    truth = _window_truth(skewed)
    assert all(got[t] == pytest.approx(truth[t][0], rel=1e-12) for t in truth)


@pytest.fixture
def without_adaptive_execution(spark):
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", prev)


def _side(df, key="k"):
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("w"), F.sum("id").alias("s")).withColumnRenamed(key, "side_k")


@pytest.mark.parametrize("null_safe", [True, False])
def test_a_null_third_spreads(spark, without_adaptive_execution, null_safe):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else f"k{i % 50}") for i in range(3000)], "id int, k string")
    side = _side(df if null_safe else df.where("k is not null"))
    out = rel.salted_join(df, side, F.col("k"), "side_k", "w", null_safe=null_safe, rows_per_task=100)
    per_task = out.where("k is null").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) >= 4 and max(r["count"] for r in per_task) < 500
    nulls = {r.s for r in out.where("k is null").select("s").collect()}
    assert out.count() == 3000 and nulls == ({sum(range(0, 3000, 3))} if null_safe else {None})


def test_side_grows_with_the_rows_of_heavy_keys_only(spark):
    df = spark.createDataFrame([(i, f"k{i % 40}") for i in range(4000)], "id int, k string")  # 40 heavy keys
    out = rel.salted_join(df, _side(df), F.col("k"), "side_k", "w", rows_per_task=50)
    assert out.count() == 4000 and {r.s for r in out.select("s").distinct().collect()} == {
        sum(range(r, 4000, 40)) for r in range(40)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan
    salts = sum(-(-100 // 50) for _ in range(40))
    assert salts <= 40 + 4000 // 50


def test_few_keys_are_split_whatever_the_bound(spark, monkeypatch):
    monkeypatch.setattr(rel, "MOST_HEAVY", 3)
    df = spark.createDataFrame([(i, f"k{i % 40}") for i in range(4000)], "id int, k string")
    out = rel.salted_join(df, _side(df), F.col("k"), "side_k", "w", rows_per_task=1)
    assert out.where("s is not null").count() == 4000
