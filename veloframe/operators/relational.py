"""Relational operators: filters, stacking, counts, group shares, join back.

Grouped work always goes through Spark's partial + final hash aggregation,
so a station (or weekday) holding a large share of all rows is
pre-aggregated inside every map task and only one small row per task and
key crosses the shuffle. Per-group results are attached to the rows with a
plain equi-join whose side is measured first (``sized_side``): it is
computed once, its bytes are summed, and it is broadcast only within a bound;
a larger one is joined by shuffle with heavy keys split (``salted_join``).
So the big table is never shuffled to attach a small per-key result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from veloframe.sources.catalog import cut_lineage


def non_empty(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """R2: keep rows whose listed text columns are all non-empty.

    SQL three-valued logic: a NULL field makes the predicate NULL, so the
    row is dropped as well.
    """
    cond = reduce(lambda a, b: a & b, [F.col(c) != F.lit("") for c in columns])
    return df.where(cond)


def stack(*dfs: DataFrame) -> DataFrame:
    """Positional bag union of tables with the same width; duplicates stay."""
    if not dfs:
        raise ValueError("stack needs at least one DataFrame")
    widths = {len(d.columns) for d in dfs}
    if len(widths) != 1:
        raise ValueError(f"stack needs equal widths, got {sorted(widths)}")
    return reduce(lambda a, b: a.union(b), dfs)


def stack_tagged(parts: Mapping[str, DataFrame], tag: str = "part") -> DataFrame:
    """U1 with a source tag, so per-part counts take one pass over the stack."""
    return stack(*[d.withColumn(tag, F.lit(name)) for name, d in parts.items()])


def part_counts(parts: Mapping[str, DataFrame], tag: str = "part", total: str | None = "all") -> DataFrame:
    """A1: row count per part (and of the whole stack) in one job.

    The stack is counted per part first; the grand total adds up those few
    rows.
    """
    counts = stack_tagged(parts, tag).groupBy(tag).agg(F.count(F.lit(1)).alias("n"))
    if total is None:
        return counts
    out = counts.rollup(tag).agg(F.sum("n").alias("n"))
    return out.select(F.coalesce(F.col(tag), F.lit(total)).alias(tag), F.coalesce("n", F.lit(0)).alias("n"))


def group_count(df: DataFrame, key: str, name: str = "n", ordered: bool = True) -> DataFrame:
    """A2 + O1: rows per key value, in key order."""
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(key) if ordered else out


def class_counts(df: DataFrame, key: str, class_col: str, classes: Mapping[str, str],
                 total: str = "total_trips", extra: Mapping[str, Column] | None = None) -> DataFrame:
    """A3 + A4: per key, the number of rows of each class and of all rows.

    ``classes`` maps an output name to the class value it counts. A NULL
    class counts only in the total. ``extra`` adds further aggregates
    computed in the same pass.
    """
    aggs = [F.count_if(F.col(class_col) == F.lit(v)).alias(name) for name, v in classes.items()]
    aggs.append(F.count(F.lit(1)).alias(total))
    aggs += [c.alias(n) for n, c in (extra or {}).items()]
    return df.groupBy(key).agg(*aggs)


#: Bytes of a join side that may be broadcast.
BROADCAST_BYTES = 8 << 20
#: Rows of one key that one task takes, and the most keys that are split.
ROWS_PER_TASK, MOST_HEAVY = 1_000_000, 10_000
#: Parts that rows without a partner (NULL keys) are spread over.
NULL_PARTS = 1024


def row_bytes(df: DataFrame) -> Column:
    """Bytes of one row: the text's own length, 16 per value besides."""
    out = F.lit(16)
    for f in df.schema.fields:
        out = out + 16
        if isinstance(f.dataType, StringType):
            out = out + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
    return out


def measured_bytes(df: DataFrame) -> int:
    """Measured size of ``df``; runs one job."""
    return int(df.agg(F.sum(row_bytes(df))).first()[0] or 0)


def sized_side(stats: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """Write a per-key result once, measure it, and mark it for broadcast when it fits.

    Runs two jobs: one writes the result (``cut_lineage``, so no executor
    memory is held), one sums its bytes. Above ``max_bytes`` (default
    ``BROADCAST_BYTES``) it stays a normal join side.
    """
    limit = BROADCAST_BYTES if max_bytes is None else max_bytes
    stats = cut_lineage(stats, "stats")
    small = limit > 0 and measured_bytes(stats) <= limit
    return (F.broadcast(stats) if small else stats), small


def salted_sides(df: DataFrame, side: DataFrame, key: Column, side_key: str, weight: str,
                 null_safe: bool = False, rows_per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join with heavy keys split: ``df`` with ``__salt``, ``side`` with ``__salt_r``.

    ``side`` is unique on ``side_key`` and ``weight`` holds how many rows of
    ``df`` carry each key. A key with more than ``rows_per_task`` rows gets
    one salt per that many; its rows take a salt from a hash of the row (the
    same on a retry), and the side's row is repeated once per salt. So the
    side grows by total / rows_per_task rows at most. At most ``MOST_HEAVY``
    keys are split (beyond, more rows count as one task's), so their table,
    16 bytes a key by hash, is broadcast. NULL keys that match nothing are
    spread as well. Runs one job, which sums the weights.
    """
    total = int(side.agg(F.sum(weight)).first()[0] or 0)
    per = max(rows_per_task, -(-total // MOST_HEAVY))
    salts = F.greatest(F.ceil(F.col(weight) / per), F.lit(1)).cast("int")
    heavy = (side.where(F.col(weight) > per).groupBy(F.xxhash64(side_key).alias("__hash"))
             .agg(F.max(salts).alias("__salts")))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    left = (df.join(F.broadcast(heavy), F.xxhash64(key) == F.col("__hash"), "left")
            .withColumn("__salt", F.pmod(row, F.when(key.isNull() & F.lit(not null_safe), F.lit(NULL_PARTS))
                                         .otherwise(F.coalesce("__salts", F.lit(1)))).cast("int"))
            .drop("__hash", "__salts"))
    many = heavy.withColumnRenamed("__hash", "__hash_r")
    right = (side.join(F.broadcast(many), F.xxhash64(side_key) == F.col("__hash_r"), "left")
             .withColumn("__salt_r", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)))
             .drop("__hash_r", "__salts"))
    return left, right


def salted_join(df: DataFrame, side: DataFrame, key: Column, side_key: str, weight: str,
                null_safe: bool = False, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Left outer equi-join with a large side, splitting heavy keys by their weight (``salted_sides``)."""
    left, right = salted_sides(df, side, key, side_key, weight, null_safe, rows_per_task)
    cond = key.eqNullSafe(F.col(side_key)) if null_safe else key == F.col(side_key)
    return left.join(right, cond & (F.col("__salt") == F.col("__salt_r")), "left").drop("__salt", "__salt_r")


def attach(df: DataFrame, stats: DataFrame, key: str, null_safe: bool = False,
           max_broadcast_bytes: int | None = None, weight: str | None = None) -> DataFrame:
    """Left outer equi-join of per-key results onto every row.

    ``stats`` is unique on ``key`` (an aggregate), so no row fans out; the
    right copy of the key is dropped. ``null_safe`` matches a NULL key with
    the NULL group (window semantics); otherwise NULL keys get NULLs. The
    join side is measured first (``sized_side``: two jobs run here). Beyond
    the broadcast bound, ``weight`` (the per-key row count, when the
    aggregate has one) lets the join split heavy keys (``salted_join``).
    """
    right_key = f"__{key}_r"
    r, small = sized_side(stats.withColumnRenamed(key, right_key), max_broadcast_bytes)
    if not small and weight:
        out = salted_join(df, r, F.col(key), right_key, weight, null_safe)
        return out.drop(right_key, weight)
    cond = F.col(key).eqNullSafe(F.col(right_key)) if null_safe else F.col(key) == F.col(right_key)
    out = df.join(r, cond, "left").drop(right_key)
    return out.drop(weight) if weight else out


def first_rows(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """O3: the first ``n`` rows in a total order (a top-n report)."""
    return df.orderBy(*order_by).limit(n)
