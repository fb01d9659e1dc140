"""From ``documents`` to packed training sequences, in stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and reread as the next stage's ``docs``. All but the last
return the columns of ``docs``. Rows with null or empty text pass the filters;
each operator's module states its cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.llm import jaccard_join, mixing, packing, secret_scan, toxicity
from veloframe.llm.common import ROW, packed, read, unpacked, with_text, written

NEAR_WIDTH, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    chain = toxicity.train(docs, read(spark, sf_dir, "labels"))
    scored = packed(docs).withColumn("found", toxicity.toxicity(F.col(f"{ROW}.text"), chain))
    return unpacked(scored.where(F.col("found.score") < toxicity.THRESHOLD))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: ``NEAR_PERCENT`` of their shingles of ``NEAR_WIDTH`` words
    in common. op10 has values of its own."""
    return jaccard_join.one_of_each(docs, NEAR_PERCENT, NEAR_WIDTH)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by its kind."""
    return with_text(docs, secret_scan.redacted(F.col("text")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' words in the mix, a row per document and pass."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can state neither the trained model nor the drawn mix; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
