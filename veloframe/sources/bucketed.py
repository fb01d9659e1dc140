"""J1 without a shuffle: both sides stored in the same buckets, heavy keys split before bucketing.

A table bucketed by its key alone puts a hot key into one bucket, which one task reads. Here the rows of a
heavy key first get one of several salts and the other side's row is repeated per salt
(``relational.salted_sides``); both tables are then bucketed, and sorted, by key and salt. A join on both
columns reads bucket by bucket: no exchange, and no bucket has more than its share of a hot key. Writing
costs the one shuffle that every later join saves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.operators.relational import ROWS_PER_TASK, salted_sides
from veloframe.sources.catalog import read_table, save_table

SALT = "__salt"


@dataclass(frozen=True)
class BucketedPair:
    """Names of two tables in the same buckets of ``key`` and salt."""

    rows: str
    side: str
    key: str
    weight: str


def save_bucketed_pair(df: DataFrame, side: DataFrame, key: str, weight: str, names: tuple[str, str],
                       buckets: int, paths: tuple[str, str] | None = None, mode: str = "errorifexists",
                       rows_per_task: int = ROWS_PER_TASK) -> BucketedPair:
    """Write ``df`` and ``side`` (unique on ``key``; ``weight`` has the rows of ``df`` per key) as tables.

    Each is dealt by the buckets' own hash before it is written, so a bucket is one file. NULL keys of
    ``df`` match nothing and are spread by the row. Jobs run here.
    """
    if SALT in df.columns or SALT in side.columns:
        raise ValueError(f"a column is called {SALT}")
    right_key = f"__{key}_r"
    left, right = salted_sides(df, side.withColumnRenamed(key, right_key), F.col(key), right_key, weight,
                               rows_per_task=rows_per_task)
    right = right.withColumnsRenamed({right_key: key, "__salt_r": SALT}).where(F.col(key).isNotNull())
    for k, part in enumerate((left, right)):
        save_table(part.repartition(buckets, key, SALT), names[k], mode, bucket_by=(buckets, [key, SALT]),
                   path=paths[k] if paths else None)
    return BucketedPair(*names, key, weight)


def join_bucketed(spark: SparkSession, pair: BucketedPair) -> DataFrame:
    """Every row with its key's side columns (NULL without a match), joined bucket by bucket."""
    rows, side = read_table(spark, pair.rows), read_table(spark, pair.side)
    return rows.join(side.hint("merge"), [pair.key, SALT], "left").drop(SALT, pair.weight)
