"""Period tables: loads that can be run again, and per-key state kept per period.

A period table is a folder of Parquet files partitioned by period. A load writes its period's partition
alone, by Spark's dynamic partition overwrite, so loading a period again replaces it and leaves the files of
all other periods as they are. Beside the rows lies a manifest, partitioned alike: the source files of each
period with their size and time of change. A load whose files are the manifest's does nothing.

The manifest is written last, after the rows and what is derived from them (``operators.state``): a run
that was cut off leaves a manifest that does not name its files, so the next run loads the period anew.
Loads of one period must not run at the same time; loads of different periods may.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veloframe.operators.relational import non_empty
from veloframe.sources.catalog import drop_folder, folder_exists
from veloframe.sources.ingest import load_checked

PERIOD = "period"
ROWS, MANIFEST, REJECTS = "rows", "manifest", "rejects"
MANIFEST_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("bytes", T.LongType()),
    T.StructField("modified", T.TimestampType())])
REJECT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("file", "line", "reason")])


def replace_period(df: DataFrame, path: str, period: str) -> None:
    """Write ``df`` as the whole content of one period; other periods' files stay as they are. A period
    without rows loses its partition, which a dynamic overwrite alone would leave. ``df`` is looked at twice, so
    it should be a stored table."""
    if df.isEmpty():
        drop_folder(df.sparkSession, f"{path}/{partition(period)}")
        return
    (df.withColumn(PERIOD, F.lit(period)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(path))


def partition(period: str) -> str:
    """Folder name of a period, which must be plain so that its name needs no escape."""
    if not period or not all(c.isalnum() or c in "-_." for c in period):
        raise ValueError(f"a period is named by letters, digits, '-', '_' and '.', not {period!r}")
    return f"{PERIOD}={period}"


def read_periods(spark: SparkSession, path: str, schema: T.StructType, periods: list[str] | None = None) -> DataFrame:
    """The rows of all periods, or of some (only their partitions are read), with the period as text."""
    full = T.StructType([*schema.fields, T.StructField(PERIOD, T.StringType())])
    if not folder_exists(spark, path):
        return spark.createDataFrame([], full)
    df = spark.read.schema(full).parquet(path)
    return df if periods is None else df.where(F.col(PERIOD).isin(*periods))


def listed_files(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """file, bytes, modified of the files below the given paths; their content is not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(files).select(
        F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


@dataclass(frozen=True)
class PeriodLoad:
    """Whether the load ran, and its counts (empty where it did not)."""

    loaded: bool
    counts: dict[str, int]


class PeriodTable:
    """Rows, rejects and manifest of one dataset, below ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def rows(self, periods: list[str] | None = None) -> DataFrame:
        return read_periods(self.spark, f"{self.root}/{ROWS}", self.schema, periods)

    def rejects(self, periods: list[str] | None = None) -> DataFrame:
        return read_periods(self.spark, f"{self.root}/{REJECTS}", REJECT_SCHEMA, periods)

    def manifest(self, periods: list[str] | None = None) -> DataFrame:
        return read_periods(self.spark, f"{self.root}/{MANIFEST}", MANIFEST_SCHEMA, periods)

    def is_current(self, period: str, files: str | list[str]) -> bool:
        """Whether the manifest names just these files, unchanged since."""
        columns = MANIFEST_SCHEMA.fieldNames()
        both = (listed_files(self.spark, files).select(*columns, F.lit(1).alias("side"))
                .unionByName(self.manifest([period]).select(*columns, F.lit(2).alias("side"))))
        found = both.groupBy(*columns).agg(F.sum("side").alias("sides")).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("sides") == 3).alias("same")).first()
        return found["n"] > 0 and found["n"] == found["same"]

    def load(self, period: str, files: str | list[str], header: str | None = "file",
             reject: tuple[str, ...] = ("short",), required_text: list[str] | None = None,
             again: bool = False, derive: Callable[[DataFrame], None] | None = None) -> PeriodLoad:
        """Load the files as the period's whole content; nothing happens where the manifest has them already,
        unless ``again`` is set. Short lines go to the rejects, incomplete rows (``required_text``) go.
        ``derive`` is given the period's stored rows before the manifest is written, for tables made of them."""
        partition(period)
        if not again and self.is_current(period, files):
            return PeriodLoad(False, {})
        seen = listed_files(self.spark, files)
        found = load_checked(self.spark, files, self.schema, header, reject)
        good = non_empty(found.good, required_text) if required_text else found.good
        replace_period(good, f"{self.root}/{ROWS}", period)
        replace_period(found.rejects, f"{self.root}/{REJECTS}", period)
        if derive:
            derive(self.rows([period]).drop(PERIOD))
        replace_period(seen, f"{self.root}/{MANIFEST}", period)
        found.drop()
        return PeriodLoad(True, found.counts)
