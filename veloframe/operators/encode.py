"""Categorical encoding, vector assembly and train/validation splits.

Indexing (value -> rank by falling frequency, ties by text) is done
relationally so that no column's full set of values passes through one task
or the driver:

1. value counts per (column, value) by grouped aggregation (pre-combined
   in every map task, so a hot value costs one row per task);
2. a distributed total order by (column, count desc, value) via range
   partitioning; each row's position inside its sorted range partition comes
   from ``monotonically_increasing_id`` (partition id in the high bits, row
   number in the low bits);
3. per (column, partition) counts -- bounded by columns x partitions -- give
   each partition's starting offset and each column's number of categories;
4. index = offset + position; the label table is joined back per column
   (broadcast while the labels' measured bytes fit, else a shuffle join
   that splits heavy values, ``relational.salted_join``).

The index columns carry nominal ML metadata (number of categories), so
``OneHotEncoder`` needs no extra pass to learn its widths.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veloframe.operators.relational import BROADCAST_BYTES, salted_join
from veloframe.sources.catalog import cut_lineage, drop_files

HANDLE_INVALID = ("error", "keep", "skip")
_LOW_BITS = (1 << 33) - 1


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col, value, n): occurrences of each non-NULL value's text, per column."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in cols]))
    long = df.select(pairs.alias("kv")).select("kv.col", "kv.value")
    return long.where(F.col("value").isNotNull()).groupBy("col", "value").agg(
        F.count(F.lit(1)).alias("n"))


def frequency_labels_with_sizes(df: DataFrame, cols: Sequence[str],
                                partitions: int | None = None) -> tuple[DataFrame, dict[str, int]]:
    """(col, value, n, idx) label table and the number of categories per column.

    idx is the 0-based rank by falling count, ties by value text. The
    sorted counts are written with their positions, so both are read from
    files ever after. Only the per-(column, partition) counts -- at most
    columns x partitions rows -- come to the driver, to turn positions into
    offsets. Three jobs run here; the label table is written by column, so a
    join reads its own column's part.
    """
    labels, sizes = _labels(df, cols, partitions)
    return labels, {c: n for c, (n, _) in sizes.items()}


def _labels(df: DataFrame, cols: Sequence[str], partitions: int | None = None
            ) -> tuple[DataFrame, dict[str, tuple[int, int]]]:
    """The label table, and per column its categories and their bytes."""
    counts = value_counts(df, cols)
    order = [F.col("col"), F.col("n").desc(), F.col("value")]
    # Without an explicit count adaptive execution sizes the range exchange
    # by data volume; merged neighbours stay in order, which is all the
    # offsets below rely on.
    spread = counts.repartitionByRange(partitions, *order) if partitions else counts.repartitionByRange(*order)
    ranked = cut_lineage(spread.sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id()),
                         "ranked")
    pos = F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))
    part = F.shiftright(F.col("_mid"), 33)
    per_part = sorted(
        (r["col"], r["_pid"], r["_cnt"], r["_first"], r["_bytes"]) for r in
        ranked.groupBy("col", part.alias("_pid")).agg(
            F.count(F.lit(1)).alias("_cnt"), F.min(pos).alias("_first"),
            F.sum(F.octet_length("value") + 48).alias("_bytes")).collect())
    offsets, sizes = [], {}
    for c, pid, cnt, first, size in per_part:
        n, total = sizes.get(c, (0, 0))
        offsets.append((c, int(pid), n - int(first)))
        sizes[c] = (n + int(cnt), total + int(size))
    shift = df.sparkSession.createDataFrame(offsets, "col string, _pid long, _shift long")
    labels = ranked.withColumn("_pid", part).join(F.broadcast(shift), ["col", "_pid"]).select(
        "value", "n", (F.col("_shift") + pos).alias("idx"), "col")
    labels = cut_lineage(labels, "labels", partition_by=["col"])
    drop_files(ranked)
    return labels.select("col", "value", "n", "idx"), sizes


def frequency_labels(df: DataFrame, cols: Sequence[str], partitions: int | None = None) -> DataFrame:
    """(col, value, n, idx): 0-based rank by falling count, ties by value text."""
    return frequency_labels_with_sizes(df, cols, partitions)[0]


def label_sizes(labels: DataFrame) -> dict[str, tuple[int, int]]:
    """Categories per column and their bytes (one small row per column)."""
    return {r["col"]: (int(r["k"]), int(r["b"])) for r in labels.groupBy("col").agg(
        F.count(F.lit(1)).alias("k"), F.sum(F.octet_length("value") + 48).alias("b")).collect()}


def require_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fails the job on a NULL in ``cols``, whichever columns are read later."""
    for c in cols:
        df = df.where(F.when(F.col(c).isNull(), F.raise_error(F.lit(f"NULL value in column {c}"))).otherwise(True))
    return df


def _nominal(name: str, k: int) -> dict:
    return {"ml_attr": {"type": "nominal", "num_vals": int(k), "name": name}}


def index_columns(df: DataFrame, cols: Sequence[str], handle_invalid: str = "error",
                  labels: DataFrame | None = None, output_suffix: str | None = None,
                  max_broadcast_bytes: int | None = None) -> DataFrame:
    """M1: replace each column by its frequency index (double).

    As the indexing helper of the trip jobs does, the index replaces the
    column under its own name and moves to the end of the row (give
    ``output_suffix`` to keep the column and add ``<col><suffix>`` instead).
    Numbers are indexed through their text. ``labels`` fitted on other rows
    (say, the training part) may lack a value. For NULL and such unseen
    values, ``handle_invalid`` ``error`` fails the job (by a filter, so also
    when the index is not read later), ``keep`` gives the index k (one past
    the last), ``skip`` drops the row.

    Each column's labels are joined on their own: smallest first they are
    broadcast while their measured bytes together fit one bound
    (``max_broadcast_bytes``, default ``relational.BROADCAST_BYTES``), the
    others by a shuffle join that splits heavy values. Fitting labels runs
    three jobs; given labels are measured by one.
    """
    if handle_invalid not in HANDLE_INVALID:
        raise ValueError(f"handle_invalid must be one of {HANDLE_INVALID}")
    fitted = labels is None
    labels, sizes = _labels(df, cols) if fitted else (labels, label_sizes(labels))
    left = BROADCAST_BYTES if max_broadcast_bytes is None else max_broadcast_bytes
    broadcast = set()
    for c in sorted(cols, key=lambda c: sizes.get(c, (0, 0))[1]):
        left -= sizes.get(c, (0, 0))[1]
        if left >= 0:
            broadcast.add(c)
    out = df
    if fitted and handle_invalid == "error":
        out = require_values(out, cols)
    for i, c in enumerate(cols):
        # label columns get names of their own per join, so no input column
        # (say one called "value") can clash with them
        text = F.col(c).cast("string")
        side = labels.where(F.col("col") == c).select(
            F.col("value").alias(f"__v{i}"), F.col("idx").alias(f"__idx{i}"), F.col("n").alias(f"__n{i}"))
        if c in broadcast:
            out = out.join(F.broadcast(side.drop(f"__n{i}")), F.col(f"__v{i}") == text, "left")
        else:  # many categories: shuffle join that splits heavy values
            out = salted_join(out, side, text, f"__v{i}", f"__n{i}")
    base = [c for c in df.columns if output_suffix or c not in cols]
    exprs = [F.col(f"`{c}`") for c in base]
    for i, c in enumerate(cols):
        idx = F.col(f"__idx{i}")
        k = sizes.get(c, (0, 0))[0]
        if handle_invalid == "skip":
            out = out.where(F.col(c).isNotNull() if fitted else idx.isNotNull())
        elif handle_invalid == "error" and not fitted:
            out = out.where(F.when(idx.isNull(), F.raise_error(
                F.concat(F.lit(f"value without a label in column {c}: "), F.coalesce(F.col(c).cast("string"), F.lit("NULL")))
            )).otherwise(True))
        idx = idx.cast("double")
        if handle_invalid == "keep":
            idx, k = F.coalesce(idx, F.lit(float(k))), k + 1
        name = c + output_suffix if output_suffix else c
        exprs.append(idx.alias(name, metadata=_nominal(name, k)))
    return out.select(*exprs)


#: Widest vector whose metadata names each of its features. Names of more would be held by the driver with every
#: schema and written into every file.
MOST_NAMED = 1_000


def _width(df: DataFrame, column: str) -> int | None:
    """Features that a column adds to a vector, as far as its metadata tells; a number adds one."""
    field = df.schema[column]
    if field.dataType.typeName() in ("vector", "udt", "vectorudt"):
        return field.metadata.get("ml_attr", {}).get("num_attrs")
    return 1


def _unnamed(column: str, width: int | None, name: str | None = None) -> F.Column:
    """The vector column, beyond ``MOST_NAMED`` features with its width alone as metadata."""
    if width is None or width <= MOST_NAMED:
        return F.col(f"`{column}`").alias(name or column)
    return F.col(f"`{column}`").alias(name or column, metadata={"ml_attr": {"num_attrs": width}})


def one_hot(df: DataFrame, cols: Sequence[str], drop_last: bool = False) -> DataFrame:
    """M2: each index column -> a sparse unit vector under its own name.

    Width = number of categories (from the index metadata; ``drop_last``
    False keeps all of them).
    """
    values = {c: df.schema[c].metadata.get("ml_attr", {}).get("num_vals") for c in cols}
    widths = {c: None if k is None else k - drop_last for c, k in values.items()}
    tmp = [f"__oh_{c}" for c in cols]
    model = OneHotEncoder(inputCols=list(cols), outputCols=tmp, dropLast=drop_last).fit(df)
    out = model.transform(df)
    renamed = dict(zip(tmp, cols))
    kept = [c for c in df.columns if c not in cols]
    return out.select(*[F.col(f"`{c}`") for c in kept], *[_unnamed(t, widths[renamed[t]], renamed[t]) for t in tmp])


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """M3: concatenate numbers and vectors, in list order, into one vector."""
    widths = [_width(df, c) for c in cols]
    made = VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(df)
    width = None if None in widths else sum(widths)
    if width is None or width <= MOST_NAMED:
        return made
    return made.select(*[F.col(f"`{c}`") for c in df.columns], _unnamed(out, width))


def labelled_points(df: DataFrame, label_source: str, features: str = "features",
                    key: str | None = None) -> DataFrame:
    """M4: (features, label[, key]) with ``label_source`` renamed to ``label``."""
    return df.select(features, F.col(label_source).alias("label"), *([key] if key else []))


def vector_width(df: DataFrame, column: str = "features") -> int:
    """Width of an assembled vector column, from its metadata."""
    return int(df.schema[column].metadata["ml_attr"]["num_attrs"])


def entry_indices(vector: str) -> F.Column:
    """Indices of a vector's non-zero entries, as array<int>."""
    return F.transform(entries(vector), lambda e: e["index"])


def entries(vector: str) -> F.Column:
    """A vector's non-zero entries, as array<struct<index int, value double>>, read from the struct that a vector
    is stored as; a sparse vector is not expanded to its width. A dense one has no list of indices."""
    stored = F.unwrap_udt(F.col(vector))
    values = stored["values"]
    at = F.coalesce(stored["indices"], F.sequence(F.lit(0), F.size(values) - 1))
    pairs = F.zip_with(at, values, lambda i, v: F.named_struct(F.lit("index"), i, F.lit("value"), v))
    return F.filter(pairs, lambda e: e["value"].isNotNull() & (e["value"] != 0))


# Hash split, bucket = first 8 hex digits of md5(key text) mod 100.
SPLIT_BUCKETS = 100
SPLIT_HEX_DIGITS = 8


def hash_bucket(key) -> F.Column:
    k = F.col(key) if isinstance(key, str) else key
    hexpart = F.substring(F.md5(k.cast("string")), 1, SPLIT_HEX_DIGITS)
    return F.conv(hexpart, 16, 10).cast("bigint") % SPLIT_BUCKETS


def split_by_hash(df: DataFrame, key: str, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """M5 (repeatable): train = bucket < ``train_percent``, validation = the rest.

    The same row always lands in the same part, whatever the partitioning
    or a retry, and no sort is needed.
    """
    b = hash_bucket(key)
    return df.where(b < train_percent), df.where(b >= train_percent)


def random_draw(key: str, seed: int) -> F.Column:
    """A number from 0 to below 1 for a key: the first 8 hex digits of md5("seed:key") by 2^32."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), 1, SPLIT_HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / float(1 << (4 * SPLIT_HEX_DIGITS))


def split_random(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42,
                 key: str | None = None) -> list[DataFrame]:
    """M5 (as in the jobs): a seeded random split by ``weights``.

    With ``key`` the draw is ``random_draw`` of it and the seed, which SQL states as well; without, a hash of
    the whole row. Either way the parts are the same on any partitioning and any number of cores; equal keys,
    or rows, go together.
    """
    draw = random_draw(key, seed) if key else (
        F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.lit(seed)), F.lit(1 << 30)) / float(1 << 30))
    ends, total = [], 0.0
    for w in weights:
        total += w / sum(weights)
        ends.append(total)
    starts = [float("-inf"), *ends[:-1]]
    ends[-1] = float("inf")
    return [df.where((draw >= a) & (draw < b)) for a, b in zip(starts, ends, strict=True)]
