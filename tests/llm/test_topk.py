import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from veloframe.llm import topk as T
from veloframe.llm.queries import op9_kd_top_k


def brute(rows, k=20):
    """rows: (id, ints) of usable vectors."""
    out = set()
    for i, q in rows:
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in rows if j != i)
            out |= {(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores[:k])}
    return out


def result(df):
    return {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("shard_rows", [60, 10_000])
def test_equals_brute_force_with_ties(spark, shard_rows):
    r = random.Random(0)
    rows = [(i, [r.randint(-3, 3) for _ in range(6)]) for i in range(500)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(3)
    got = T.top_k(df, "vec_id", "v", F.col("vec_id") % 20 == 0, shard_rows=shard_rows)
    assert result(got) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [2 ** 30 + i, -(2 ** 29), i]) for i in range(45)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    assert result(T.top_k(df, "vec_id", "v", F.col("vec_id") % 20 == 0)) == brute(rows)


def test_boxes_prune(monkeypatch):
    rng = np.random.default_rng(0)
    rows = np.concatenate([rng.integers(-5, 6, (2000, 4)), rng.integers(900, 1000, (2000, 4))])
    tree = T.build(np.arange(4000), rows, 64)
    q = np.array([[1, 1, 1, 1]])
    bound = np.maximum(q, 0) @ tree.high.T + np.minimum(q, 0) @ tree.low.T
    ids, scores = next(iter(T.search(tree, np.array([-1]), q, np.array([-np.inf]), 5)))
    assert ((bound[0][tree.left == 0] < scores.min()).sum()) > 30 and len(ids) == 5


def test_query_on_odd_rows(spark, folder):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25], "x"), (20, [0.1, 0.2], "x"), (21, None, "x"), (22, [None, 1.0], "x"), (23, [nan, 1.0], "x"),
            (40, [inf, 1.0], "x"), (None, [1.0, 1.0], "x"), (1, [0.5, 0.5], "x"), (2, [0.5, 0.5], "x"), (3, [-0.01, 0.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    usable = [(i, np.floor(64 * np.array(np.float32(v), np.float64)).astype(int).tolist()) for i, v, _ in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    assert result(op9_kd_top_k(spark, folder(embeddings=df))) == brute(usable)


def test_repeated_rows_and_empty_table(spark, folder):
    rows = [(0, [1.0]), (0, [1.0]), (5, [1.0]), (5, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in op9_kd_top_k(spark, folder(embeddings=df)).collect())
    assert got == [(0, 1, 5), (0, 2, 5)]
    none = spark.createDataFrame([], "vec_id long, v array<long>")
    assert T.top_k(none, "vec_id", "v", F.col("vec_id") % 20 == 0).count() == 0
