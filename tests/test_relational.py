"""Relational operators: filter, stack, counts, shares, join back."""

import pytest

from veloframe.operators import relational as rel
from veloframe.functions.compare import share


def test_non_empty_drops_blank_and_null(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, "", "b"), (3, None, "b"), (4, "a", "")],
                               "id int, x string, y string")
    assert [r.id for r in rel.non_empty(df, ["x", "y"]).collect()] == [1]


def test_stack_is_positional_and_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, id int").select("id", "s")
    c = rel.stack(a, b, a)
    assert c.count() == 3
    with pytest.raises(ValueError):
        rel.stack(a, a.select("id"))


def test_part_counts_one_pass(spark):
    a = spark.range(5)
    b = spark.range(7)
    got = {r.part: r.n for r in rel.part_counts({"first": a, "second": b}).collect()}
    assert got == {"first": 5, "second": 7, "all": 12}


def test_group_count_ordered(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (0,)], "d int")
    assert [(r.d, r.n) for r in rel.group_count(df, "d").collect()] == [(0, 1), (1, 1), (3, 2)]


@pytest.mark.parametrize("w,n,want", [(57, 200, 0.29), (29, 200, 0.15), (201, 200, 1.01),
                                      (1, 3, 0.33), (2, 3, 0.67), (0, 5, 0.0), (5, 5, 1.0)])
def test_share_rounds_half_up(spark, w, n, want):
    df = spark.createDataFrame([(w, n)], "w long, n long")
    assert df.select(share("w", "n").alias("s")).first().s == want


def test_class_counts_null_class_only_in_total(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("a", "y")], "k string, c string")
    r = rel.class_counts(df, "k", "c", {"nx": "x", "ny": "y"}).first()
    assert (r.nx, r.ny, r.total_trips) == (1, 1, 3)


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_attach_broadcast_and_shuffle_paths_agree(spark, max_bytes):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "c")], "id int, k string")
    stats = spark.createDataFrame([("a", 10), (None, 20), ("b", 30)], "k string, v int")
    strict = rel.attach(df, stats, "k", null_safe=False, max_broadcast_bytes=max_bytes)
    safe = rel.attach(df, stats, "k", null_safe=True, max_broadcast_bytes=max_bytes)
    assert {r.id: r.v for r in strict.collect()} == {1: 10, 2: None, 3: 30, 4: None}
    assert {r.id: r.v for r in safe.collect()} == {1: 10, 2: 20, 3: 30, 4: None}
    plan = safe._jdf.queryExecution().executedPlan().toString()
    if max_bytes == 0:
        assert "BroadcastHashJoin" not in plan or "AdaptiveSparkPlan" in plan
    else:
        assert "BroadcastHashJoin" in plan


def test_first_rows_is_ordered(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "x int")
    assert [r.x for r in rel.first_rows(df, 2, ["x"]).collect()] == [1, 2]


def test_part_counts_scans_once_and_adds_up_few_rows(spark):
    out = rel.part_counts({"first": spark.range(5), "second": spark.range(0)})
    assert {r.part: r.n for r in out.collect()} == {"first": 5, "all": 5}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.index("Range")  # the rollup stands above the counts


def test_measured_bytes_follow_the_text(spark):
    df = spark.createDataFrame([("k", "x" * 2000)] * 50, "k string, v string")
    assert 100_000 < rel.measured_bytes(df) < 110_000


def test_wide_texts_are_not_broadcast(spark):
    df = spark.createDataFrame([(i, f"{i % 60}" + "y" * 2000) for i in range(300)], "id int, k string")
    stats = df.groupBy("k").count().withColumnRenamed("count", "n")
    small, big = rel.sized_side(stats, 200_000)[1], rel.sized_side(stats, 20_000)[1]
    assert small and not big
    got = rel.attach(df, stats, "k", max_broadcast_bytes=20_000, weight="n")
    assert got.count() == 300 and got.columns == ["id", "k"]
