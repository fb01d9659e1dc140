"""Exact top-k inner products with a KD-tree per shard.

Vectors are dealt by hash into shards of a fixed size. A shard's tree splits
at the median of the widest dimension and keeps a tight box per node; the box
bounds a query's inner product from above. Each shard first answers its own
queries, best box first; their kth scores go with the queries to every other
shard, where a box is opened only while its bound reaches the kth score known
so far. Queries meet shards in blocks, so no task holds all queries or rows.

Cases: vectors that are null, or hold null or non-finite components, and rows
without an id take no part; shorter vectors count as filled with zeros; ties
go to the smaller id; equal rows are separate candidates, but rows with a
query's id are its own; an empty table gives an empty result; other columns
are ignored. Scores are 64-bit integers.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veloframe.llm.common import written

SHARD_ROWS, LEAF_ROWS = 4096, 128
HITS = "query_id long, vec_id long, score long"


def usable(vector: str) -> Column:
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))


def scaled(vector: str, scale: int = 64) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


@dataclass
class Tree:
    """Rows ordered by leaf; node i has rows first[i]:last[i], a box, and children left[i], left[i] + 1
    (0: a leaf)."""

    ids: np.ndarray
    rows: np.ndarray
    first: np.ndarray
    last: np.ndarray
    left: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def packed(self) -> bytes:
        return pack(self.ids, self.rows, self.first, self.last, self.left, self.low, self.high)


def pack(*arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    for a in arrays:
        np.save(out, a, allow_pickle=False)
    return out.getvalue()


def unpack(raw: bytes, n: int) -> list[np.ndarray]:
    f = io.BytesIO(raw)
    return [np.load(f, allow_pickle=False) for _ in range(n)]


def build(ids: np.ndarray, rows: np.ndarray, leaf_rows: int = LEAF_ROWS) -> Tree:
    order, nodes, at = np.arange(len(ids)), [(0, len(ids))], 0
    left, low, high = [], [], []
    while at < len(nodes):
        a, b = nodes[at]
        own = rows[order[a:b]]
        low.append(own.min(axis=0))
        high.append(own.max(axis=0))
        spread = high[-1] - low[-1]
        if b - a > leaf_rows and spread.max(initial=0) > 0:
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, spread.argmax()], middle)]
            left.append(len(nodes))
            nodes += [(a, a + middle), (a + middle, b)]
        else:
            left.append(0)
        at += 1
    first, last = np.array(nodes).T
    return Tree(ids[order], rows[order], first, last, np.array(left), np.array(low), np.array(high))


def search(tree: Tree, query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int
           ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per query the ids and scores of its best ``k`` rows here that score at least ``least``."""
    width = max(queries.shape[1], tree.rows.shape[1])
    queries, rows, low, high = (np.pad(x, ((0, 0), (0, width - x.shape[1])))
                                for x in (queries, tree.rows, tree.low, tree.high))
    most = max(float(np.abs(queries).max(initial=0)), 1.0) * max(float(np.abs(rows).max(initial=0)), 1.0)
    if most * max(width, 1) < 2.0 ** 53:  # products and their sums are exact as doubles, and quicker
        queries, rows, low, high = (x.astype(np.float64) for x in (queries, rows, low, high))
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    for own, q, bound, kth in zip(query_ids, queries, bounds, least, strict=True):
        ids, scores = np.empty(0, np.int64), np.empty(0, rows.dtype)
        heap = [(-bound[0], 0)]
        while heap and -heap[0][0] >= kth:
            node = heapq.heappop(heap)[1]
            if child := tree.left[node]:
                for c in (child, child + 1):
                    if bound[c] >= kth:
                        heapq.heappush(heap, (-bound[c], c))
                continue
            span = slice(tree.first[node], tree.last[node])
            s = rows[span] @ q
            keep = (s >= kth) & (tree.ids[span] != own)
            if keep.any():
                ids, scores = np.concatenate([ids, tree.ids[span][keep]]), np.concatenate([scores, s[keep]])
                if len(ids) > k:
                    best = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[best], scores[best]
                if len(ids) == k:
                    kth = max(kth, scores.min())
        yield ids, scores.astype(np.int64)


def matrix(lists: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    rows = lists.to_pylist()
    width = max(map(len, rows), default=0)
    out = np.zeros((n, width), np.int64)
    for i, x in enumerate(rows):
        out[i, :len(x)] = x
    return out


def hits(query_ids: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    n = [len(i) for i, _ in found]
    empty = [np.empty(0, np.int64)]
    return [np.repeat(query_ids, n), np.concatenate([i for i, _ in found] or empty),
            np.concatenate([s for _, s in found] or empty)]


def top_k(vectors: DataFrame, vec_id: str, vector: str, is_query: Column, k: int = 20,
          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's ``k`` best rows by inner product.

    ``vector`` holds whole numbers (array<long>). Jobs run here to count the rows and to write the
    trees. A query block meets each shard once, which is the search that is asked for.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v"),
                          is_query.alias("asks")).where("id is not null and v is not null")
    n_shards = max(1, -(-rows.count() // shard_rows))
    least = np.iinfo(np.int64).min

    def prepare(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        table = table.sort_by([("id", "ascending")])
        ids = table.column("id").to_numpy()
        tree = build(ids, matrix(table.column("v"), len(ids)))
        asks = distinct(table.filter(table.column("asks")))
        query_ids, queries = asks.column("id").to_numpy(), matrix(asks.column("v"), asks.num_rows)
        found = list(search(tree, query_ids, queries, np.full(len(query_ids), least, np.float64), k))
        kth = np.array([s.min() if len(s) == k else least for _, s in found], np.int64)
        return pa.table({"shard": pa.array([shard], pa.int64()), "tree": [tree.packed()],
                         "queries": [pack(query_ids, queries, kth)], "home": [pack(*hits(query_ids, found))]})

    trees = written(
        rows.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(n_shards)))
        .groupBy("shard").applyInArrow(prepare, "shard long, tree binary, queries binary, home binary"),
        "topk-trees")

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in unpack(raw, 3)],
                                                 names=["query_id", "vec_id", "score"])

    def away(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree = Tree(*unpack(batch.column("tree")[i].as_py(), 7))
                query_ids, queries, kth = unpack(batch.column("queries")[i].as_py(), 3)
                found = list(search(tree, query_ids, queries, kth, k))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in hits(query_ids, found)],
                                                 names=["query_id", "vec_id", "score"])

    blocks = (trees.select(F.col("shard").alias("from"), "queries",
                           F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1).cast("long"))).alias("shard"))
              .where(F.col("from") != F.col("shard")))
    found = (blocks.join(trees.select("shard", "tree"), "shard").select("tree", "queries")
             .mapInArrow(away, HITS).unionByName(trees.select("home").mapInArrow(home, HITS)))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def distinct(table: pa.Table) -> pa.Table:
    """The first of equal (id, v) rows of a table ordered by id."""
    seen: set[tuple] = set()
    keep = [key not in seen and not seen.add(key) for key in
            zip(table.column("id").to_pylist(), map(tuple, table.column("v").to_pylist()), strict=True)]
    return table.filter(pa.array(keep, pa.bool_()))
