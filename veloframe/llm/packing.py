"""Packing tokenized documents into sequences: Martello-Toth reduction, then best fit.

Lengths are whole numbers up to the capacity, so an instance is a table of
counts per length, never larger than the capacity, however many documents
there are. The driver reduces and packs that table; documents take their
places by joining the resulting runs of places on (length, rank).

Cases: a null text is empty and holds the end token alone; equal rows are
packed as separate rows; an empty table gives an empty result; other columns
are ignored. A null doc_id is packed like any other.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.llm.common import running_start, texts, written

CAPACITY = 1024
END_ID = 2
SPECIAL = "<|endoftext|>"


@cache
def encoders(vocabulary: str):
    """Both readers of one byte-level vocabulary: the quick one, and the defining one.

    The quick one reads the ranks file beside the defining json file. It gives
    the same ids (tests/llm), but knows no special tokens, and it may refuse
    very long runs of white space; such texts go to the defining one.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    quick = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                              special_tokens={})
    return quick, cache(lambda: Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json")))


def encode(text: str, vocabulary: str) -> list[int]:
    quick, defining = encoders(vocabulary)
    if SPECIAL not in text:
        try:
            return quick.encode_ordinary(text)
        except (ValueError, RuntimeError):  # its pattern matcher gave up on this text
            pass
    return defining().encode(text, add_special_tokens=False).ids


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = "byte_bpe_50k",
                 end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end id, cut only
    where they exceed ``capacity``, the first piece taking the remainder."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, raw in enumerate(texts(batch.column("text"))):
                ids = np.array([*encode(raw.decode(), vocabulary), end_id], "<u4")
                first = (len(ids) - 1) % capacity + 1
                ends = range(first, len(ids) + 1, capacity)
                rows += [(i, k, s := max(0, e - capacity) if k else 0, e - s, zlib.crc32(ids[s:e]))
                         for k, e in enumerate(ends)]
            at, *rest = map(list, zip(*rows, strict=True)) if rows else [[]] * 5
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at, pa.int64())),
                 *(pa.array(x, t) for x, t in zip(rest, types, strict=True))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_pair(lengths: list[int], counts: list[int], room: int) -> int:
    """The largest sum, at most ``room``, of two of the items left; 0 if none."""
    best, i, j = 0, 0, bisect.bisect_right(lengths, room) - 1
    while i <= j:
        if lengths[i] + lengths[j] > room or i == j and counts[lengths[i]] < 2:
            j -= 1
        else:
            best, i = max(best, lengths[i] + lengths[j]), i + 1
    return best


def least(lengths: list[int], counts: list[int], k: int) -> list[int]:
    """The ``k`` shortest of the items left; an item longer than all stands for each that is missing."""
    out: list[int] = []
    for x in lengths[:k]:
        out += [x] * min(counts[x], k - len(out))
    return out + [len(counts)] * (k - len(out))


def reduce_and_fit(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Runs of places (length, rank, n, sequence, offset) and the number of sequences.

    A run places the items of one length ranked ``rank`` to ``rank + n`` at ``offset`` of the
    sequences ``sequence`` to ``sequence + n``. From the longest item down, the reduction fixes
    the set that dominates all others, of whatever items are left, holding that item: alone where nothing fits beside it;
    with an item that fills it exactly; with the longest item that fits, where no two items fit,
    or no three do and no two together are longer. What is left goes best fit, longest first.
    """
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        left[length] = n
    used, runs, n_seq = [0] * (capacity + 1), [], 0

    def put(length: int, n: int, sequence: int, offset: int) -> None:
        runs.append((length, used[length], n, sequence, offset))
        used[length] += n
        left[length] -= n

    rest = []
    for s in range(capacity, 0, -1):
        while left[s]:
            room = capacity - s
            free = left[:]
            free[s] -= 1
            present = [x for x in range(1, room + 1) if free[x] > 0]
            if not present:
                n, mate = left[s], 0
            elif (mate := present[-1]) == room or sum(least(present, free, 2)) > room or (
                    sum(least(present, free, 3)) > room and mate >= best_pair(present, free, room)):
                n = left[s] // 2 if mate == s else min(left[s], left[mate])
            else:
                rest.append(s)
                break
            put(s, n, n_seq, 0)
            if mate:
                put(mate, n, n_seq, s)
            n_seq += n
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []

    def opened(gap: int, sequence: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                bisect.insort(order, gap)
            gaps.setdefault(gap, []).append((sequence, n))

    for s in rest:
        while left[s]:
            if (at := bisect.bisect_left(order, s)) < len(order):
                gap = order[at]
                sequence, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[at]
            else:
                gap, sequence = capacity, n_seq
                n = -(-left[s] // (gap // s))
                n_seq += n
            each = gap // s
            full = min(n, left[s] // each)
            for k in range(each if full else 0):
                put(s, full, sequence, capacity - gap + k * s)
            opened(gap - each * s, sequence, full)
            if full < n and left[s]:  # too few to fill one more sequence
                k = 0
                while left[s]:
                    put(s, 1, sequence + full, capacity - gap + k * s)
                    k += 1
                opened(gap - k * s, sequence + full, 1)
                full += 1
            opened(gap, sequence + full, n - full)
    return runs, n_seq


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``pieces`` (doc_id, piece, start, length, ids_crc32).

    ``pieces`` should be written, as it is read three times; one row per length comes to the
    driver. The runs are a few per length, so they are broadcast.
    """
    spark: SparkSession = pieces.sparkSession
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}
    runs, _ = reduce_and_fit(counts, capacity)
    table = spark.createDataFrame(
        runs, "length long, first long, n long, sequence long, offset long")
    ranked = running_start(pieces, ["length"], ["doc_id", "piece", "ids_crc32", "start"], F.lit(1),
                           sum(counts.values()), "__rank")
    in_run = (F.col("__rank") >= F.col("first")) & (F.col("__rank") < F.col("first") + F.col("n"))
    return (ranked.alias("a").join(F.broadcast(table.alias("b")), (F.col("a.length") == F.col("b.length")) & in_run)
            .select("a.*", (F.col("sequence") + F.col("__rank") - F.col("first")).alias("sequence_id"), "b.offset")
            .drop("__rank"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = "byte_bpe_50k") -> DataFrame:
    return pack(written(token_pieces(docs, capacity, vocabulary), "pack-pieces"), capacity)
