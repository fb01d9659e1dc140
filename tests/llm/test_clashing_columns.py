"""Stages keep the caller's columns, whatever their names, and survive many equal rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from veloframe.llm import mixing

NAMES = ["__id", "__tie", "__copy", "__once", "__own", "__text", "__takes", "__toxicity", "__row", "found", "component",
         "tie", "copy", "epoch", "skey", "me", "size", "a b.c"]


@pytest.fixture(scope="module")
def clashing(spark, edge_docs):
    docs = edge_docs.select("doc_id", "text", "source", "n_chars")
    return docs.select("*", *[F.concat(F.lit(f"{k}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n)
                              for k, n in enumerate(NAMES)])


@pytest.mark.parametrize("name", ["toxicity", "near_copies", "secrets", "mixing"])
def test_values_of_clashing_columns_stay(spark, clashing, small_dir, name):
    out = dict(P.STAGES)[name](spark, clashing, small_dir)
    assert out.columns == clashing.columns
    rows = out.collect()
    assert rows
    for r in rows:
        own = "none" if r["doc_id"] is None else str(r["doc_id"])
        assert [r[n] for n in NAMES] == [f"{k}:{own}" for k in range(len(NAMES))]
        assert name == "mixing" or r["n_chars"] == (None if r["text"] is None else len(r["text"]))
        assert name != "mixing" or r["n_chars"] == len(r["text"])


def test_packing_ignores_other_columns(spark, clashing, small_dir):
    renamed = clashing.select("*", *[F.lit(9).alias(n) for n in ("piece", "length", "sequence_id", "offset", "__rank")])
    plain = clashing.select("doc_id", "text", "source", "n_chars")
    columns = ["doc_id", "piece", "start", "length"]
    got, want = (sorted(map(repr, P.pack_sequences(spark, d, small_dir).select(columns).collect())) for d in (renamed, plain))
    assert got == want


def test_many_equal_rows(spark):
    n, text = 10_000, " ".join(f"w{k}" for k in range(400))
    docs = spark.range(n, numPartitions=8).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text"),
                                                  F.lit("a").alias("source"), F.col("id").alias("__copy"))
    out = mixing.mixed(docs).select("__copy", F.size(F.split("text", r"\s+")).alias("n")).collect()
    per_row = {}
    for r in out:
        per_row[r["__copy"]] = per_row.get(r["__copy"], 0) + r["n"]
    assert abs(sum(per_row.values()) - 1.5 * 400 * n) <= mixing.BLOCK_WORDS and max(per_row.values()) <= 800
