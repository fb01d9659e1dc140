"""Mixing sources to target weights over fixed-length blocks.

Each source's documents, in a hashed order, form one stream of words that is
cut into blocks of ``BLOCK_WORDS``. Every output shard draws its source counts
from a multinomial over what each source still has to give, so the totals come
out at the targets. A slot of the output holds a source and a running number
within it; a pseudorandom permutation of the source's block indexes, one per
pass over the source, turns that number into a block. Blocks join documents
by (source, block index). A further permutation orders the slots of a shard.
Which words are taken follows from the targets alone; the draw and the slots
say where they stand in the output (``mixed_blocks``).

Cases: a null or empty text has no words and is never taken; a null source is
a source of its own, last in order; equal rows are mixed as separate rows; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veloframe.llm.common import (ROW, ROW_KEY, packed, row_key, running_start, sliced, texts, unpacked, word_count,
                                  written)
from veloframe.operators.relational import BROADCAST_BYTES, salted_join
from veloframe.sources.catalog import drop_files

#: Words in a block; a source's share is met to about one block.
BLOCK_WORDS = 64
#: Output shards; fixed, so the table of draws does not grow with the data.
OUTPUT_SHARDS = 512
WEIGHTS = (3, 1, 2)
SLOTS_PER_TASK = 1_000_000


def source_targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, share: float = 1.5,
                   most: float = 2.0) -> list[float]:
    """Words due from each source: ``share`` of all words by weight (repeating), at most
    ``most`` times the source; what is above is shared again among the others."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    left, targets, open_ = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        total = sum(w[i] for i in open_)
        over = {i for i in open_ if left * w[i] / total > most * sizes[i]}
        if not over:
            for i in open_:
                targets[i] = left * w[i] / total
            break
        for i in over:
            targets[i] = most * sizes[i]
        left -= sum(targets[i] for i in over)
        open_ -= over
    return targets


def shuffled(index: np.ndarray, domain: np.ndarray, key: np.ndarray, rounds: int = 4) -> np.ndarray:
    """A pseudorandom permutation of range(domain) for each key, at each index.

    A balanced Feistel network over the next even power of two; an image
    outside the domain is sent through again until it falls inside.
    """
    half = np.maximum(1, np.ceil(np.log2(np.maximum(domain, 2)) / 2)).astype(np.uint64)
    mask, out, todo = (np.uint64(1) << half) - np.uint64(1), index.astype(np.uint64), np.arange(len(index))
    domain, key = domain.astype(np.uint64), key.astype(np.uint64)
    while len(todo):
        h, m, x = half[todo], mask[todo], out[todo]
        left, right = x >> h, x & m
        for r in range(rounds):
            f = right + key[todo] + np.uint64((r + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            f = (f ^ (f >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            f = (f ^ (f >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((f ^ (f >> np.uint64(31))) & m)
        out[todo] = left << h | right
        todo = todo[out[todo] >= domain[todo]]
    return out.astype(np.int64)


def draws(sizes: list[int], targets: list[float], block_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks in each source, and blocks to draw from it in whole passes and one part pass.

    The last block of a source, which may be short, comes last in every pass.
    """
    n, due = [], []
    for size, target in zip(sizes, targets, strict=True):
        blocks = -(-size // block_words)
        passes = int(target // size) if size else 0
        left, full = target - passes * size, max(blocks - 1, 0)
        part = blocks if left > (full * block_words + size) / 2 else min(full, round(left / block_words))
        n.append(blocks)
        due.append(passes * blocks + part)
    return np.array(n, np.int64), np.array(due, np.int64)


def shard_counts(due: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(shards, sources): multinomial draws over what is still due, clipped to it; the last
    shard takes the rest, so each source's counts add up to ``due``."""
    rng, left = np.random.default_rng(seed), due.astype(np.int64).copy()
    size, out = -(-int(due.sum()) // shards), np.zeros((shards, len(due)), np.int64)
    for i in range(shards):
        total = int(left.sum())
        if not total:
            break
        got = left.copy() if i == shards - 1 or total <= size else np.minimum(
            rng.multinomial(size, left / total), left)
        out[i], left = got, left - got
    return out


def plan_blocks(spark, n_blocks: np.ndarray, due: np.ndarray, seed: int,
                shards: int = OUTPUT_SHARDS) -> DataFrame:
    """One row per slot of the output: shard, slot (its place in the shard), source (its number), block, epoch."""
    counts = shard_counts(due, shards, seed)
    per_shard = counts.sum(axis=1)
    shard_ends = per_shard.cumsum()
    ends = counts.ravel().cumsum()
    firsts = (counts.cumsum(axis=0) - counts).ravel()
    total, n_sources = int(ends[-1]) if len(ends) else 0, len(due)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column(0).to_numpy()
            cell = np.searchsorted(ends, slot, side="right")
            source = cell % n_sources
            j = firsts[cell] + slot - (ends[cell] - counts.ravel()[cell])
            epoch, place = j // n_blocks[source], j % n_blocks[source]
            full = n_blocks[source] - 1
            inner = place < full
            key = (source + 1) * 0x100000001B3 + epoch * 0x10001 + seed
            block = place.copy()
            block[inner] = shuffled(place[inner], full[inner], key[inner])
            shard = cell // n_sources
            own = slot - (shard_ends - per_shard)[shard]
            own = shuffled(own, per_shard[shard], (shard + 1) * 0x1000193 + seed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), pa.array(own, pa.int64()), pa.array(source, pa.int32()),
                 pa.array(block, pa.int64()), pa.array(epoch, pa.int32())],
                names=["out_shard", "slot", "source_no", "block", "epoch"])

    parts = max(1, -(-total // SLOTS_PER_TASK))
    return spark.range(0, total, 1, parts).mapInArrow(
        slots, "out_shard int, slot long, source_no int, block long, epoch int")


def source_key(source: str = "source") -> Column:
    """Never null, in order of source, null last; equal rows but for their source are numbered by it."""
    return F.concat(F.when(F.col(source).isNull(), "1").otherwise("0"), F.coalesce(source, F.lit("")))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0,
        block_words: int = BLOCK_WORDS, seed: int = 17, max_broadcast_bytes: int = BROADCAST_BYTES
        ) -> tuple[DataFrame, DataFrame]:
    """Mix ``docs`` (doc_id, text, source).

    Returns the rows (doc_id, tie, copy, source, size, source_size, target) and what the mix takes
    of them: (doc_id, tie, copy, epoch, block, first, words, out_shard, slot, place), words ``first``
    to ``first + words`` of the document, which stand in a slot of an output shard from word ``place``
    on. ``tie`` is a hash of the text and ``copy`` numbers equal rows. One row per
    source, and one per virtual column of the draws, are kept on the driver; the sources' table is
    broadcast up to ``max_broadcast_bytes``, and beyond that joined with hot sources salted. Jobs run
    here to size the sources.
    """
    spark = docs.sparkSession
    same = Window.partitionBy("doc_id", "tie").orderBy("skey")
    sized = written(
        docs.select("doc_id", F.xxhash64("text").alias("tie"), "source", word_count(F.col("text")).alias("size"))
        .withColumn("skey", source_key())
        .withColumn("copy", F.row_number().over(same)), "mix-sizes")
    sources = sorted((r[0], int(r[1]), int(r[2])) for r in sized.groupBy("skey").agg(
        F.sum("size"), F.count("*")).collect())
    sizes = [s for _, s, _ in sources]
    targets = source_targets(sizes, weights, share, most)
    n_blocks, due = draws(sizes, targets, block_words)
    table = spark.createDataFrame(
        [(k, i, s, t, n) for i, ((k, s, n), t) in enumerate(zip(sources, targets, strict=True))],
        "own_skey string, source_no int, source_size long, target double, n_rows long")
    if sum(len(k.encode()) + 96 for k, _, _ in sources) <= max_broadcast_bytes:
        rows = sized.join(F.broadcast(table), F.col("skey") == F.col("own_skey"))
    else:
        rows = salted_join(sized, table, F.col("skey"), "own_skey", "n_rows")
    rows = rows.drop("skey", "own_skey", "n_rows")
    keyed = running_start(rows, ["source_no"], ["doc_id", "tie", "copy"], F.col("size"),
                          sized.count(), "start").where("size > 0")
    spans = (keyed.select("doc_id", "tie", "copy", "source_no", "size", "start", F.explode(F.sequence(
        F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    )).alias("block")))
    first = F.greatest(F.col("block") * block_words - F.col("start"), F.lit(0))
    end = F.least((F.col("block") + 1) * block_words - F.col("start"), F.col("size"))
    taken = (spans.join(plan_blocks(spark, n_blocks, due, seed), ["source_no", "block"])
             .select("doc_id", "tie", "copy", "epoch", "block", first.alias("first"), (end - first).alias("words"),
                     "out_shard", "slot", F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0)).alias("place")))
    return rows, taken


WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def passages(raw: bytes, takes: list[dict]) -> list[str]:
    """One text per epoch: the words taken, with the white space between them where they adjoin."""
    spans = [m.span() for m in WORD.finditer(raw)]
    out: dict[int, list[list[int]]] = {}
    for take in sorted(takes, key=lambda t: (t["epoch"], t["first"])):
        first, end = take["first"], take["first"] + take["words"]
        own = out.setdefault(take["epoch"], [])
        if own and own[-1][1] == first:
            own[-1][1] = end
        else:
            own.append([first, end])
    return ["\n".join(raw[spans[a][0]:spans[b - 1][1]].decode() for a, b in own) for _, own in sorted(out.items())]


def pieces(raw: bytes, takes: list[dict]) -> list[str]:
    """The words of each take, in the order of ``takes``."""
    spans = [m.span() for m in WORD.finditer(raw)]
    return [raw[spans[t["first"]][0]:spans[t["first"] + t["words"] - 1][1]].decode() for t in takes]


def with_takes(docs: DataFrame, mix_rows: DataFrame, taken: DataFrame, fields: list[str], order: Column,
               of: str = "") -> DataFrame:
    """Each row of ``docs`` of which something is taken, with ``__takes``: a list of ``fields`` of ``taken``.

    A row that is alone with its id and text needs no number, so its text is not shuffled for one; only rows
    that share them are numbered, by ``order``, and dealt again by number. ``of`` says where id and text are. Jobs
    run here, and the sizes that ``mix`` wrote go.
    """
    key = row_key("doc_id", F.col("tie"))
    several = written(mix_rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*ROW_KEY), "mix-several")
    takes = written(taken.groupBy(*key, F.col("copy").alias("__copy")).agg(
        F.collect_list(F.struct(*fields)).alias("__takes")), "mix-takes")
    drop_files(mix_rows)
    keyed = docs.select("*", *row_key(f"{of}doc_id", F.xxhash64(f"{of}text")))
    alone = keyed.join(takes.join(several, ROW_KEY, "left_anti").drop("__copy"), ROW_KEY)
    number = F.row_number().over(Window.partitionBy(*ROW_KEY).orderBy(order))
    again = (keyed.join(several, ROW_KEY, "left_semi").withColumn("__copy", number)
             .join(takes.join(several, ROW_KEY, "left_semi"), [*ROW_KEY, "__copy"]))
    columns = [*docs.columns, "__takes"]
    return alone.select(*columns).unionByName(again.select(*columns))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: a row per document and pass, its text cut to the words taken.

    Documents of which nothing is taken are left out; all columns are kept. Jobs run here.
    """
    rows, taken = mix(docs, **options)

    @F.arrow_udf("array<string>")
    def cut(text: pa.Array, listed: pa.Array) -> pa.Array:
        kind = pa.list_(pa.string())
        return sliced(lambda c, t: pa.array([passages(*x) for x in zip(texts(c), t.to_pylist(), strict=True)], kind),
                      kind, text, listed)

    rows = with_takes(packed(docs), rows, taken, ["epoch", "first", "words"], source_key(f"{ROW}.source"), f"{ROW}.")
    return unpacked(rows.select(ROW, F.explode(cut(f"{ROW}.text", "__takes")).alias("__text")), F.col("__text"))


def mixed_blocks(docs: DataFrame, **options) -> DataFrame:
    """The mix by output shard and slot: (out_shard, slot, source, block, epoch, words, text), a row per slot.

    Slots of a shard are numbered from 0; a block's text holds the pieces of its documents in their order. Jobs
    run here.
    """
    rows, taken = mix(docs, **options)

    @F.arrow_udf("array<string>")
    def cut(text: pa.Array, listed: pa.Array) -> pa.Array:
        kind = pa.list_(pa.string())
        return sliced(lambda c, t: pa.array([pieces(*x) for x in zip(texts(c), t.to_pylist(), strict=True)], kind),
                      kind, text, listed)

    fields = ["epoch", "block", "first", "words", "out_shard", "slot", "place"]
    rows = with_takes(docs.select("doc_id", "text", "source"), rows, taken, fields, source_key())
    one = (rows.select("source", F.explode(F.arrays_zip("__takes", cut("text", "__takes").alias("__text"))).alias("x"))
           .select("source", "x.__takes.*", F.col("x.__text").alias("text")))
    return (one.groupBy("out_shard", "slot")
            .agg(F.first("source").alias("source"), F.first("block").alias("block"), F.first("epoch").alias("epoch"),
                 F.sum("words").alias("words"), F.sort_array(F.collect_list(F.struct("place", "text"))).alias("pieces"))
            .select("out_shard", "slot", "source", "block", "epoch", "words",
                    F.array_join(F.transform("pieces", lambda x: x["text"]), "\n").alias("text")))
