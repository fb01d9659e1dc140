"""The registered queries opN_<name>: each applies one operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.llm import (fingerprints, html_extract, html_training, jaccard_join, lexical, mixing, oracle, packing, quality, runs,
                           secret_scan, sharding, substring_dedup, topk, toxicity)
from veloframe.llm.common import read, written
from veloframe.sources.catalog import shared_path


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base kinds, spans of all kinds."""
    found = read(spark, sf_dir, "documents").select(
        "doc_id", secret_scan.secret_spans(F.col("text")).alias("found"))

    def count(kind: str):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    base = F.filter("found", lambda x: x["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select("doc_id", *map(count, secret_scan.BASE_KINDS),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("found")).alias("spans"))


def op2_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score, toxic words and their offsets of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return (docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
                        toxicity.toxicity(F.col("text"), chain).alias("found"))
            .select("doc_id", "held_out", "found.score",
                    (F.col("found.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                    "found.n_toxic", F.to_json("found.spans").alias("spans")))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-word windows that an earlier document holds."""
    cleaned = substring_dedup.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "n_removed",
                          F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op4_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 24 shards of near-equal bytes, by virtual slots and the stored map."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    sized = docs.select(
        "doc_id", F.coalesce(F.octet_length("text") + 8, F.lit(8)).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    slotted = written(sharding.with_virtual_slot(sized, "doc_id", "text_crc32"), "shard-sizes")
    start = sharding.initial_map(24)
    edited = sharding.rebalance(start, sharding.slot_bytes(slotted, "size"))
    path = shared_path(spark, f"slot-map-{uuid.uuid4().hex}")
    for version in (start, edited):
        sharding.save_map(spark, version, path)
    placed = sharding.place(slotted, sharding.load_map(spark, path, edited.version), ["doc_id", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")


def op5_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses."""
    return fingerprints.fingerprints(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, and the output shards they stand in."""
    rows, taken = mixing.mix(read(spark, sf_dir, "documents"))
    key = ["doc_id", "tie", "copy"]
    words = taken.groupBy(*key).agg(
        F.sum("words").alias("taken"),
        F.array_join(F.sort_array(F.collect_set("out_shard")).cast("array<string>"), ",").alias("shards")).alias("t")
    rows = rows.alias("r")
    on = [F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}")) for k in key]
    return rows.join(words, on, "left").select(
        "r.doc_id", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source",
        F.coalesce("shards", F.lit("")).alias("out_shards"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequence and place."""
    return packing.pack_documents(read(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    model = html_extract.fit(html_training.labelled_pages())
    text = html_extract.extracted(F.col("html"), model).alias("text")
    return (read(spark, sf_dir, "pages").select("page_id", "url", text)
            .withColumn("n_chars", F.char_length("text").cast("long")))


def op9_kd_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for every embedding whose id is divisible by 20."""
    vectors = (read(spark, sf_dir, "embeddings").where(topk.usable("embedding"))
               .select("vec_id", topk.scaled("embedding").alias("embedding")))
    return topk.top_k(vectors, "vec_id", "embedding", F.col("vec_id") % 20 == 0)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document."""
    found = jaccard_join.jaccard_components(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, of which a tenth is made periodic first, and digests of the runs and of the
    text without their repeats. A null doc_id's text stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    start = F.floor(h / 10).cast("long")
    text = runs.made_periodic(F.col("text"), start, F.when(h % 10 == 0, start % 8 + 3))
    found = (read(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
             .select("doc_id", runs.periodic_runs(F.col("text")).alias("found"))
             .select("doc_id", "found.runs", "found.collapsed")
             .withColumn("best", runs.most_repeated(F.col("runs"))))
    lines = F.array_join(F.transform("runs", lambda x: F.concat(
        F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return lexical.lexical_top_k(read(spark, sf_dir, "documents").select("doc_id", "text"),
                                 read(spark, sf_dir, "benchmark").select("item_id", "text"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return (docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"),
                        quality.quality(F.col("text"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_secret_scan, op2_crf_toxicity, op3_substring_dedup, op4_slot_sharding, op5_simhash_fingerprints, op6_source_mixing, op7_best_fit_packing,
                                op8_html_extraction, op9_kd_top_k, op10_jaccard_join, op11_periodic_runs, op12_lexical_search,
                                op13_quality_classifier)}

#: The others cannot be stated in SQL; tests/llm holds all against brute force.
SQL: dict[str, str] = dict(oracle.SQL)
