"""Exact ranked lexical search with sparse ball-trees.

A document's score for an item is an inner product: the item's side has its terms' occurrences times
their weights, the document's side a saturated count per term, all integers. Only terms of items take part,
so vectors are kept over the items' vocabulary. Documents are dealt into shards of about
``SHARD_ENTRIES`` vector entries; each shard's tree splits at the median between two far documents and
keeps a centroid and a radius per node (in coordinates scaled by the root of the term's weight, which
narrows the balls). No document below a node scores above centroid product + query norm * radius, where
the norm counts the node's terms only; bounds are rounded up, and a node is opened, best bound first, only
while its bound reaches the kth score known. Leaves are scored in 64-bit integers. A sixteenth of the
shards is searched first; its kth scores go along to the others.

Items are searched in blocks of ``BLOCK_BYTES`` of text (and what the last one has beyond), so what is
sent to the tasks is bounded; each block reads all documents. Terms are runs of ASCII letters, digits and
characters beyond ASCII; only A-Z is lower-cased.

Cases: null, empty and blank texts hold no terms and are never found; items without terms find nothing;
very long texts are counted whole; ties go to the smaller doc_id, a null one last; repeated rows are
documents of their own, repeated items are answered each; an empty table on either side gives an empty
result; other columns are not read. Scores stay exact below 2^63: 25 * (terms of a document) * (number of
documents) must.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veloframe.llm.common import running_start, texts, written

#: Bytes of item texts that are searched at one time.
BLOCK_BYTES = 4 << 20
#: Vector entries of a shard, about, and documents of a leaf.
SHARD_ENTRIES, LEAF_ROWS = 300_000, 64
#: Part of the shards that is searched first.
FIRST_PART = 16
#: Relative rounding that bounds are raised by; far above what sums of doubles lose.
SAFE = 1e-9

#: Fixed values of the score: scale, saturation and length parts.
SCALE, RISE, SATURATION, FULL, BY_LENGTH, WEIGHT = 1_000_000_000, 1000, 12, 100, 25, 1000

HITS = "query int, doc_id long, score long"
HIT_SCHEMA = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])
LAST_ID = np.iinfo(np.int64).max

#: Bytes outside of terms become spaces, A-Z lower case; bytes of characters beyond ASCII stay.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


@dataclass
class Sparse:
    """Rows of term numbers, exact values and scaled values."""

    ids: np.ndarray
    start: np.ndarray
    term: np.ndarray
    exact: np.ndarray
    scaled: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, rows: np.ndarray) -> Sparse:
        n = np.diff(self.start)[rows]
        start = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(start[-1]) + np.repeat(self.start[:-1][rows] - start[:-1], n)
        return Sparse(self.ids[rows], start, self.term[at], self.exact[at], self.scaled[at])

    def products(self, values: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Each row's sum of values * dense[term]; every row has an entry."""
        return np.add.reduceat(values * dense[self.term], self.start[:-1])


@dataclass
class Node:
    term: np.ndarray
    centroid: np.ndarray
    radius: float
    leaf: Sparse | None
    children: tuple[Node, ...]


def distances(rows: Sparse, dense: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Squared distances of the rows from a point, not rounded to safety."""
    return squares - 2 * rows.products(rows.scaled, dense) + dense @ dense


def ball_tree(rows: Sparse, vocabulary: int) -> Node:
    """Tree over the rows; halves of equal size, so its depth is the logarithm of their number."""
    squares = np.add.reduceat(rows.scaled ** 2, rows.start[:-1])
    center = np.bincount(rows.term, rows.scaled, vocabulary) / len(rows)
    away = distances(rows, center, squares)
    slack = SAFE * (squares.max() + center @ center) + SAFE
    radius = math.sqrt(max(float(away.max()), 0.0) + slack)
    at = np.flatnonzero(center)
    if len(rows) <= LEAF_ROWS:
        return Node(at, center[at], radius, rows, ())
    ends = []
    for _ in range(2):
        row = rows.take(np.array([int(np.argmax(away))]))
        point = np.bincount(row.term, row.scaled, vocabulary)
        away = distances(rows, point, squares)
        ends.append(away)
    order = np.argsort(ends[0] - ends[1], kind="stable")
    half = len(rows) // 2
    children = tuple(ball_tree(rows.take(np.sort(part)), vocabulary) for part in (order[:half], order[half:]))
    return Node(at, center[at], radius, None, children)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def upper_bound(node: Node, scaled: np.ndarray) -> float:
    """No row below the node scores more. Values are not negative, so a term that the centroid lacks no row
    has, and the query's norm counts over the node's terms only."""
    own = scaled[node.term]
    return (float(own @ node.centroid) + math.sqrt(float(own @ own)) * node.radius) * (1 + SAFE) + 1


def search(tree: Node, exact: np.ndarray, scaled: np.ndarray, k: int, least: int,
           opened: Callable[[int], None] = lambda rows: None) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows (at least ``least``) of a tree for one query, given dense over the vocabulary."""
    ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    heap, number = [(-upper_bound(tree, scaled), 0, tree)], 1
    while heap:
        upper, _, node = heapq.heappop(heap)
        if -upper < least:
            break
        if node.leaf is None:
            for child in node.children:
                heapq.heappush(heap, (-upper_bound(child, scaled), number, child))
                number += 1
            continue
        opened(len(node.leaf))
        found = node.leaf.products(node.leaf.exact, exact)
        good = found >= least
        if good.any():
            ids, scores = best(np.concatenate([ids, node.leaf.ids[good]]), np.concatenate([scores, found[good]]), k)
            if len(scores) == k:
                least = max(least, int(scores[-1]))
    return ids, scores


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """(item_id, text) of the items that have a text, block by block."""
    kept = items.where(F.length("text") > 0).select("item_id", "text", F.lit(0).alias("one"))
    count = kept.count()
    if not count:
        return
    placed = written(running_start(kept, ["one"], ["item_id", "text"], F.octet_length("text").cast("long"), count, "at")
                     .select(F.floor(F.col("at") / BLOCK_BYTES).cast("long").alias("block"), "item_id", "text"),
                     "lexical-items")
    for block in sorted(r["block"] for r in placed.select("block").distinct().collect()):
        rows = placed.where(F.col("block") == block).select("item_id", "text").collect()
        yield sorted(((i, t.encode()) for i, t in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, number of all terms, and number and occurrences of each term of the vocabulary; written."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, numbers, often = [], [], []
            for raw in texts(batch.column("text")):
                words = terms(raw)
                held = Counter(map(vocabulary.get, words))
                held.pop(None, None)
                sizes.append(len(words))
                numbers.append(list(held))
                often.append(list(held.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(numbers, pa.list_(pa.int32())), pa.array(often, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "counts"])

    rows = docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n long, terms array<int>, counts array<long>")
    return written(rows, "lexical-counts")


@dataclass
class Weights:
    """Weight per term number, and the documents and terms of the whole table."""

    weight: np.ndarray
    documents: int
    terms: int


def weights(counts: DataFrame, vocabulary: int) -> Weights:
    """From all documents; the driver gets a number per term of the items' vocabulary."""
    n, length = counts.where(F.col("n") > 0).agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    out = np.zeros(vocabulary, np.int64)
    for term, df in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        out[term] = math.floor(WEIGHT * math.log((2 * n + 2) / (2 * df + 1)))
    return Weights(out, n, length)


def shard_rows(batch: pa.Table, known: Weights) -> Sparse:
    n = batch.column("n").to_numpy()
    listed = batch.column("terms").combine_chunks()
    start = listed.offsets.to_numpy().astype(np.int64)
    term = listed.flatten().to_numpy()
    tf = batch.column("counts").combine_chunks().flatten().to_numpy()
    length = FULL - BY_LENGTH + (BY_LENGTH * n * known.documents) // known.terms
    exact = (SCALE * tf) // (RISE * tf + SATURATION * np.repeat(length, np.diff(start)))
    ids = batch.column("doc_id").fill_null(LAST_ID).to_numpy()
    return Sparse(ids, start - start[0], term, exact, exact * np.sqrt(known.weight[term]))


def searched(shards: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], known: Weights, k: int,
             least: dict[int, int]) -> DataFrame:
    """The k best hits of each query in each shard that reach the query's ``least`` score; written."""
    def answer(table: pa.Table) -> pa.Table:
        tree = ball_tree(shard_rows(table, known), len(known.weight))
        exact, scaled = np.zeros(len(known.weight), np.int64), np.zeros(len(known.weight))
        root = np.sqrt(known.weight)
        out = []
        for q, (term, often) in enumerate(queries):
            exact[term] = often * known.weight[term]
            scaled[term] = often * root[term]
            ids, scores = search(tree, exact, scaled, k, max(1, least.get(q, 1)))
            exact[term] = 0
            scaled[term] = 0
            out.append((np.full(len(ids), q, np.int32), ids, scores))
        query, ids, scores = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.Table.from_arrays([pa.array(query), pa.array(ids, mask=ids == LAST_ID), pa.array(scores)],
                                    schema=HIT_SCHEMA)

    return written(shards.groupBy("shard").applyInArrow(answer, HITS), "lexical-hits")


def ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def lexical_top_k(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item, of all whose score is above 0."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(items):
        vocabulary: dict[bytes, int] = {}
        queries = []
        for _, text in block:
            own = Counter(vocabulary.setdefault(t, len(vocabulary)) for t in terms(text))
            queries.append((np.array(list(own), np.int64), np.array(list(own.values()), np.int64)))
        counts = term_counts(docs, vocabulary)
        known = weights(counts, len(vocabulary))
        held = counts.where(F.size("terms") > 0)
        entries = held.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
        if not entries:
            continue
        n = -(-entries // SHARD_ENTRIES)
        # numbers of the written rows, as equal rows would meet in one shard by a hash of their values
        shards = held.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)))
        first = -(-n // FIRST_PART)
        hits = searched(shards.where(F.col("shard") < first), queries, known, k, {})
        if first < n:
            least = {r["query"]: r["score"] for r in ranked(hits, k).where(F.col("rank") == k).collect()}
            hits = hits.unionByName(searched(shards.where(F.col("shard") >= first), queries, known, k, least))
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], "query int, item_id long")
        out = out.unionByName(ranked(hits, k).join(F.broadcast(names), "query")
                              .select("item_id", "rank", "doc_id", "score"))
    return out
