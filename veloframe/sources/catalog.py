"""Table sinks and scans, persistence and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from veloframe.session import shared_folder


def save_table(df: DataFrame, name: str, mode: str = "overwrite",
               partition_by: list[str] | None = None,
               bucket_by: tuple[int, list[str]] | None = None,
               path: str | None = None) -> None:
    """Write ``df`` as a catalog table.

    ``mode='overwrite'`` lets a job be re-run; ``'errorifexists'`` is the
    strict form. ``bucket_by=(n, cols)`` stores the table hash-bucketed so
    later joins and aggregations on ``cols`` need no shuffle. Without
    ``path`` the table is managed (files in the warehouse); with ``path``
    the files live there, and an overwrite replaces them even when the
    catalog entry came from another session.
    """
    writer = df.write.mode(mode)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
    writer.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table by name."""
    return spark.table(name)


def keep(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Keep ``df`` in executor memory (spilling to disk) once computed."""
    return df.persist(level)


def cut_lineage(df: DataFrame, name: str = "cut", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and read it back.

    One job computes ``df`` once; later jobs read the files, so a lost
    executor costs a re-read, not a replay of the lineage. The files also
    give Spark exact sizes for its join planning. (``Dataset.checkpoint``
    would compute an unpersisted input twice.) Runs one job. The files stay
    until ``drop_files`` removes them or the folder is cleaned.
    """
    spark = df.sparkSession
    path = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_files(written: DataFrame) -> None:
    """Remove the files of a table that ``cut_lineage`` returned, when nothing reads it any more."""
    spark = written.sparkSession
    root = shared_path(spark)
    folders = set()
    for name in written.inputFiles():
        below = name.rpartition("/veloframe/")[2]
        folders.add(f"{root.rstrip('/')}/{below.split('/')[0]}")
    for folder in folders:
        drop_folder(spark, folder)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder, in whatever store it is; nothing happens where there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A location below the session's shared checkpoint folder."""
    return "/".join([shared_folder(spark).rstrip("/"), "veloframe", *parts])
