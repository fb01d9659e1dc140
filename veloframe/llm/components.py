"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veloframe.llm.common import written
from veloframe.sources.catalog import drop_files


def connected_components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: longs); the component is its least node.

    Each round links every node to the least node around it, first for larger neighbours, then for
    smaller ones; edges never outnumber those given, and the rounds grow with the logarithm of a
    component's size. The edges of a round are written, so a lost executor costs a read, and go when the next
    round is written; the result reads the last one. Jobs run here.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first())

    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a <> b").distinct(), "cc")
    now = state(edges)
    for _ in range(rounds):
        if not now[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        done, edges = edges, written(small, "cc")
        drop_files(done)
        before, now = now, state(edges)
        if now == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
