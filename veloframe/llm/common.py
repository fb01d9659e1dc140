"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import veloframe
from veloframe.session import table_path
from veloframe.sources.catalog import cut_lineage

_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}

#: Rows of a window or sort group, about; the number of groups grows with the table.
GROUP_ROWS = 50_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(table_path(sf_dir, table))


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, once per application, as ``--py-files`` does, where only the
    driver's own path has it."""
    root = Path(veloframe.__file__).resolve().parent.parent
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or str(root) in map(os.path.realpath, os.environ.get("PYTHONPATH", "").split(os.pathsep)):
        return
    _SHIPPED[app] = tempfile.TemporaryDirectory()  # the driver serves the file until it ends
    spark.sparkContext.addPyFile(shutil.make_archive(f"{_SHIPPED[app].name}/{app}", "zip", root, "veloframe"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a parquet table in the folder that the driver and the executors share."""
    return cut_lineage(df, name)


#: Rows of a batch whose texts are Python objects at one time.
SLICE_ROWS = 256


def texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a text column, nulls as empty, a slice of rows at a time."""
    for at in range(0, len(column), SLICE_ROWS):
        yield from (x or b"" for x in column.slice(at, SLICE_ROWS).cast(pa.binary()).to_pylist())
    pa.default_memory_pool().release_unused()


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``SLICE_ROWS``, where a batch's output is as large as its texts."""
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            yield whole.slice(at, SLICE_ROWS)
    pa.default_memory_pool().release_unused()


def sliced(make: Callable[..., pa.Array], empty: pa.DataType, *columns: pa.Array) -> pa.Array:
    """``make`` of the columns, a slice of rows at a time."""
    parts = [make(*(c.slice(at, SLICE_ROWS) for c in columns)) for at in range(0, len(columns[0]), SLICE_ROWS)]
    out = pa.concat_arrays(parts) if parts else pa.array([], empty)
    pa.default_memory_pool().release_unused()
    return out


def groups_for(rows: int) -> int:
    return max(4, -(-rows // GROUP_ROWS))


def word_count(text: Column) -> Column:
    """Runs of characters other than space, tab, \\n, \\v, \\f and \\r; null text has none."""

    @F.arrow_udf(T.LongType())
    def count(column: pa.Array) -> pa.Array:
        return pa.array([len(x.split()) for x in texts(column)], pa.int64())

    return count(text)


#: A row's key for joins: never null, and what ``with_copy`` partitions by, so that a join shuffles no text again.
ROW_KEY = ["__id", "__tie"]


def row_key(doc_id: str, tie: Column) -> list[Column]:
    return [F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("__id"), tie.alias("__tie")]


def with_copy(docs: DataFrame, order: Column | None = None, of: str = "") -> DataFrame:
    """``docs`` with ``ROW_KEY`` (the id and a hash of the text) and ``__copy``, numbering the rows of a key,
    by ``order`` if given. ``of`` (``"__row."``) says where id and text are."""
    keyed = docs.select("*", *row_key(f"{of}doc_id", F.xxhash64(f"{of}text")))
    order = F.col("__tie") if order is None else order
    return keyed.withColumn("__copy", F.row_number().over(Window.partitionBy(*ROW_KEY).orderBy(order)))


#: All of the caller's columns, as one struct.
ROW = "__row"


def packed(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` in ``ROW``, so that no name of the caller's meets one that an operator adds."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(ROW))


def unpacked(rows: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns that were packed; with ``text``, that in place of the text, and n_chars counted anew."""
    row = F.col(ROW)
    if text is not None:
        row = row.withField("text", text)
        kind = {f.name: f.dataType for f in rows.schema[ROW].dataType.fields}.get("n_chars")
        if kind is not None:
            row = row.withField("n_chars", F.char_length(text).cast(kind))
    return rows.select(row.alias(ROW)).select(f"{ROW}.*")


def with_text(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with another text, and n_chars, where there is one, counted anew."""
    docs = docs.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        docs = docs.withColumn("n_chars", F.char_length("text").cast(kind))
    return docs


def running_start(df: DataFrame, key: list[str], order: list[str], size: Column,
                  rows: int, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``size`` over the earlier rows of the same ``key``.

    A key may hold any share of the rows, so its rows are dealt by a hash of
    ``order`` into groups of about ``GROUP_ROWS``; rows are ordered by group,
    then by ``order``. Sums run within a group, and one row per group and key
    gives the group's start. Rows equal in ``order`` take any order among them.
    ``key`` must not be null.
    """
    groups = groups_for(rows)
    part, amount, base = "__part", "__amount", "__base"
    dealt = df.withColumns({part: F.pmod(F.xxhash64(*order), F.lit(groups)), amount: size})
    totals = (dealt.groupBy(*key, part).agg(F.sum(amount).alias("__total"))
              .withColumn(base, F.coalesce(F.sum("__total").over(
                  Window.partitionBy(*key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)),
                  F.lit(0)))
              .drop("__total"))
    within = Window.partitionBy(*key, part).orderBy(*order)
    return (dealt
            .withColumn(name, F.sum(amount).over(
                within.rowsBetween(Window.unboundedPreceding, 0)) - F.col(amount))
            .join(totals, [*key, part])
            .withColumn(name, (F.col(name) + F.col(base)).cast("long"))
            .drop(part, amount, base))
