from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as P
from veloframe.llm import jaccard_join, mixing, secret_scan, toxicity

from .test_near_copies_stage import kept_by_brute


def test_stages_take_effect(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    seen, columns = {}, docs.columns
    for name, stage in P.STAGES:
        before = docs
        docs = stage(spark, docs, small_dir).cache()
        seen[name] = (before, docs)
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    before, after = seen["toxicity"]
    chain = toxicity.train(before, spark.read.parquet(f"{small_dir}/labels.parquet"))
    found = dict(before.select("doc_id", toxicity.toxicity(F.col("text"), chain)["score"]).collect())
    assert {r["doc_id"] for r in after.collect()} == {i for i, s in found.items() if s < toxicity.THRESHOLD}
    before, after = seen["near_copies"]
    want = kept_by_brute([(r["doc_id"], r["text"]) for r in before.collect()], P.NEAR_WIDTH, P.NEAR_PERCENT)
    assert Counter(r["doc_id"] for r in after.collect()) == Counter(want)
    before, after = seen["secrets"]
    texts = {r["doc_id"]: r["text"] for r in after.collect()}
    for r in before.collect():
        assert texts[r["doc_id"]] == secret_scan.redact(r["text"], secret_scan.scan(r["text"]))
    before, after = seen["mixing"]
    sizes = Counter()
    for r in before.collect():
        sizes[r["source"]] += len(r["text"].encode().split())
    order = sorted(sizes)
    targets = mixing.source_targets([sizes[s] for s in order])
    taken = Counter()
    for r in after.collect():
        taken[r["source"]] += len(r["text"].encode().split())
    assert all(abs(taken[s] - t) <= mixing.BLOCK_WORDS for s, t in zip(order, targets, strict=True))
    before, after = seen["packing"]
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()}


def test_stages_on_edge_rows(spark, edge_docs, no_docs, folder, small_dir):
    for docs in (edge_docs, no_docs):
        for name, stage in P.STAGES:
            out = stage(spark, docs, small_dir)
            assert name == "packing" or out.columns == docs.columns
            assert (out.count() > 0) == (docs is edge_docs)
