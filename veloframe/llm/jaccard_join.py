"""N-gram Jaccard join by T-occurrence search (DivideSkip), with components of the links.

Linked documents share all but a tenth or so (a fifth at 80 percent) of their
shingles and have nearly equal sizes. So a document whose sampled shingles are, but for too few, held
by no other document of a like size has no links; the sample is taken by hash,
the same shingles in all documents of a size class. What is left is connected
through one hub per short list, never through all pairs, and the components of
these edges are searched one by one. In a search by DivideSkip, a set has to
occur in T of the asking set's inverted lists: all but the T - 1 longest are
merged with a heap, which counts occurrences, and the long ones are probed by
binary search. Documents already connected are passed over, so links come out
as a spanning forest. A candidate component larger than a chunk is searched by
pairs of chunks, which is exact as well.

Cases: null and empty texts have no shingles and no links, and are their own
component; equal sets, from exact copies above all, are searched once; rows of
one doc_id belong together; a null doc_id takes part but never names a
component, which is null if it holds no other; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veloframe.llm.common import ROW, ROW_KEY, packed, row_key, running_start, small, texts, unpacked, with_copy, written
from veloframe.llm.components import connected_components
from veloframe.sources.catalog import drop_files

WIDTH, PERCENT = 3, 90
#: From this percent on, (size, rate): in size classes that begin up to this size, sets are sampled at this rate.
#: Two linked sets share no sampled shingle with a chance below 1e-12, less than that of equal hashes in a large
#: corpus: (1 - rate) to the power of the shared ones is 3e-15 at most for 90 (117 at 0.25), 3e-16 for 80 (52 at
#: 0.5). A rate has to exceed the share that linked sets may lack, or every set stays a candidate.
RATES = ((90, ((64, 1.0), (128, 0.5), (256, 0.25), (None, 0.1875))),
         (80, ((64, 1.0), (256, 0.5), (None, 0.3125))),
         (0, ((None, 1.0),)))
#: The exact way: every set whole, so that no link rests on a chance.
EXACT = ((0, ((None, 1.0),)),)
#: Shingles of one chunk of a candidate component.
CHUNK = 2_000_000
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(raw: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text, words cut at ASCII white space."""
    words = raw.translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out = h[:len(h) - width + 1].copy()
    for k in range(1, width):
        out = out * MIX + h[k:len(h) - width + 1 + k]
    return np.unique(out)


def least_shared(n: int, percent: int) -> int:
    """T: shingles that a set of ``n`` shares with any set it is linked to, at least."""
    return -(-n * percent // 100)


def size_class(n: int, percent: int) -> int:
    """Linked sizes, which differ by ``percent`` at most, fall into the same or the next class."""
    return int(math.log(n) / math.log(100 / (percent - 1))) if n else 0


def limit(step: int, percent: int, rates: tuple = RATES) -> int:
    """Hashes up to this, as signed numbers in order, are sampled in a size class."""
    begins = step * math.log(100 / (percent - 1))
    by_size = next(by_size for least, by_size in rates if percent >= least)
    rate = next(rate for size, rate in by_size if size is None or begins <= math.log(size))
    return int(rate * 2 ** 64) - 2 ** 63 - 1


def sketches(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, rates: tuple = RATES) -> DataFrame:
    """(doc_id, tie, n, s1, s2, step, m, m_next, sample): set size, 128-bit set digest, size class, and the
    hashes sampled in that class, ``m`` of them, of which ``m_next`` are sampled in the next class too."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, step, m_next, digest, sample = [], [], [], [], []
            for raw in texts(batch.column("text")):
                s = shingles(raw, width)
                signed = (s ^ np.uint64(1 << 63)).view(np.int64)  # in order of s
                n.append(len(s))
                step.append(size_class(len(s), percent))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()))
                own, after = np.searchsorted(
                    signed, [limit(k, percent, rates) for k in (step[-1], step[-1] + 1)], "right")
                sample.append(signed[:own])
                m_next.append(int(after))
            pairs = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
            m = [len(x) for x in sample]
            ends = np.cumsum([0, *m], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), pa.array(n, pa.int32()), pa.array(pairs[:, 0]),
                 pa.array(pairs[:, 1]), pa.array(step, pa.int32()), pa.array(m, pa.int32()),
                 pa.array(m_next, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(
                     np.concatenate(sample) if sample else np.empty(0, np.int64)))],
                names=["doc_id", "tie", "n", "s1", "s2", "step", "m", "m_next", "sample"])

    return docs.select("doc_id", F.xxhash64("text").alias("tie"), "text").mapInArrow(
        sketch, f"doc_id {kind}, tie long, n int, s1 long, s2 long, step int, m int, m_next int, sample array<long>")


def held_by_several(lists: DataFrame, key: list[str]) -> DataFrame:
    """``lists`` (with node) where more than one node has the key; adds ``held``, how many have."""
    several = lists.groupBy(*key).agg(F.count("*").alias("held")).where("held > 1")
    return lists.join(several, key)


def candidate_edges(nodes: DataFrame, percent: int = PERCENT, rates: tuple = RATES) -> DataFrame:
    """(a, b): each node that may have links, with the least such node of every short list it is in.

    A linked set lacks at most ``lacks`` of a set's shingles, so a set has no links in a size class where
    more of its sample is held by no other set; and of the ``lacks + 1`` rarest of its sample, the short
    lists, a linked set holds one. Sets are sampled alike in a class, and each is in its own and the next.
    Jobs run here.
    """
    step_limit = F.lit(limit(10 ** 4, percent, rates))
    steps = [k for k in range(200) if limit(k, percent, rates) != limit(k + 1, percent, rates)]
    for k in reversed(steps):
        step_limit = F.when(F.col("step") <= k, F.lit(limit(k, percent, rates))).otherwise(step_limit)
    lacks = (F.col("n") - F.ceil(F.col("n") * percent / 100)).cast("int")
    sizes = nodes.select("node", "step", "m", "m_next", lacks.alias("lacks"))
    lists = written(held_by_several(nodes.select("node", F.explode("sample").alias("shingle")), ["shingle"])
                    .select("node", "shingle"), "join-lists")
    held = lists.groupBy("node").agg(F.collect_list("shingle").alias("shingles"))
    both = F.array(F.struct("step", "m"), F.struct((F.col("step") + 1).alias("step"), F.col("m_next").alias("m")))
    sets = (sizes.join(held, "node").select("node", "lacks", "shingles", F.inline(both))
            .withColumn("shingles", F.filter("shingles", lambda x: x <= step_limit)))
    last = lists
    for _ in range(2):  # sets without links leave the lists, which frees others
        sets = sets.where(F.col("m") - F.size("shingles") <= F.col("lacks"))
        rows = sets.select("node", "step", "m", "lacks", F.explode("shingles").alias("shingle"))
        sets = written(
            held_by_several(rows, ["shingle", "step"]).groupBy("node", "step", "m", "lacks")
            .agg(F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("held"))
            .withColumn("shingles", F.transform("held", lambda x: x["shingle"])), "join-sets")
        drop_files(last)
        last = sets
    shorts = F.slice("shingles", 1, F.col("lacks") + 1 - (F.col("m") - F.size("shingles")))
    short = (sets.where(F.col("m") - F.size("shingles") <= F.col("lacks"))
             .select("node", "step", F.explode(shorts).alias("shingle")))
    hubs = short.groupBy("shingle", "step").agg(F.min("node").alias("hub"))
    edges = written(short.join(hubs, ["shingle", "step"]).where("node <> hub")
                    .select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), "join-edges")
    drop_files(last)
    return edges


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def t_occurrence(sets: list[np.ndarray], indexed: np.ndarray, percent: int = PERCENT) -> Iterator[tuple[int, int]]:
    """Links (query, indexed set) that connect sets not connected before.

    ``indexed`` marks the sets of the inverted lists. A marked set asks for earlier marked ones
    only; an unmarked one asks for all marked ones.
    """
    which = np.flatnonzero(indexed)
    if not len(which):
        return
    every, owner = np.concatenate([sets[i] for i in which]), np.repeat(which, [len(sets[i]) for i in which])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    keys, starts = np.unique(every, return_index=True)
    ends = np.append(starts[1:], len(every))
    sizes, forest = np.array([len(s) for s in sets]), Forest(len(sets))
    within = bool(indexed.all())
    for q, s in enumerate(sets):
        if indexed[q] != within:
            continue
        at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
        there = keys[at] == s
        lengths = np.where(there, ends[at] - starts[at], 0)
        lists = np.flatnonzero(lengths > within)  # within, its own entry is in every list
        t = least_shared(len(s), percent)
        if len(lists) < t:
            continue
        lists = lists[np.argsort(lengths[lists], kind="stable")]
        short, long_ = lists[:len(lists) - t + 1], lists[len(lists) - t + 1:]
        seen: dict[int, int] = {}
        for y in heapq.merge(*(owner[starts[at[k]]:ends[at[k]]].tolist() for k in short)):
            seen[y] = seen.get(y, 0) + 1
        mine = forest.root(q)
        found = [y for y in seen if (y < q if within else True) and forest.root(y) != mine
                 and 100 * sizes[y] >= percent * sizes[q] and 100 * sizes[q] >= percent * sizes[y]]
        if not found:
            continue
        cand = np.array(found)
        count = np.array([seen[y] for y in found])
        need = -(-percent * (sizes[cand] + sizes[q]) // (100 + percent))
        if len(cand) <= len(long_):  # probe each candidate's set for the long lists' shingles
            probes = s[long_]
            for i, y in enumerate(found):
                own = sets[y]
                count[i] += int((own[np.minimum(np.searchsorted(own, probes), len(own) - 1)] == probes).sum())
        else:
            for left, k in zip(range(len(long_), 0, -1), long_, strict=True):
                keep = count + left >= need
                if not keep.all():
                    cand, count, need = cand[keep], count[keep], need[keep]
                if not len(cand):
                    break
                posting = owner[starts[at[k]]:ends[at[k]]]
                count = count + (posting[np.minimum(np.searchsorted(posting, cand), len(posting) - 1)] == cand)
        for y in cand[count >= need].tolist():
            if forest.join(q, y):
                yield q, y


def links(docs: DataFrame, candidates: DataFrame, percent: int = PERCENT, chunk: int = CHUNK,
          width: int = WIDTH) -> DataFrame:
    """(a, b): links between nodes of the same candidate component, enough to connect what is linked.

    ``candidates``: (component, node, doc_id, tie, n), with a row of ``docs`` for each node.
    """
    spread = running_start(candidates, ["component"], ["n", "node"], F.col("n"), candidates.count(), "start")
    spread = spread.withColumn("chunk", F.floor(F.col("start") / chunk).cast("int")).drop("start")
    chunks = spread.groupBy("component").agg(F.max("chunk").alias("last"))
    wanted = spread.join(chunks, "component").select(
        "component", "chunk", "last", "node", F.col("doc_id").alias("w_id"), F.col("tie").alias("w_tie"))
    wanted = wanted.hint("merge")  # one plan at every size: both sides are dealt by document
    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    rows = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["w_id"]) & (rows["tie"] == wanted["w_tie"])).select(
        "component", "chunk", "last", "node", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            sets = [shingles(x, width).tobytes() for x in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sets, pa.binary())],
                                             names=["component", "chunk", "last", "node", "shingles"])

    sets = rows.mapInArrow(build, "component long, chunk int, last int, node long, shingles binary")
    cells = F.transform(F.sequence(F.lit(0), F.col("last")), lambda other: F.struct(
        F.least(F.col("chunk"), other).alias("i"), F.greatest(F.col("chunk"), other).alias("j")))
    cells = sets.select("component", "chunk", "node", "shingles", F.explode(cells).alias("cell")).select(
        "component", "cell.i", "cell.j", "chunk", "node", "shingles")

    def search(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        table = table.sort_by([("node", "ascending")])
        nodes, raw = table.column("node").to_numpy(), table.column("shingles").to_pylist()
        marked = np.ones(len(nodes), bool) if i == j else table.column("chunk").to_numpy() == i
        found = list(t_occurrence([np.frombuffer(x, np.uint64) for x in raw], marked, percent))
        return pa.table({"a": pa.array([int(nodes[x]) for x, _ in found], pa.int64()),
                         "b": pa.array([int(nodes[y]) for _, y in found], pa.int64())})

    return cells.groupBy("component", "i", "j").applyInArrow(search, "a long, b long")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, chunk: int = CHUNK,
                       width: int = WIDTH, rates: tuple = RATES) -> DataFrame:
    """(doc_id, tie, n_shingles, component, component_id) of each row of ``docs`` (doc_id, text).

    ``tie`` is a hash of the text. Two documents link when the intersection of their sets of
    shingles of ``width`` words is at least ``percent`` of the union; component_id is the least doc_id that links reach, and
    ``component`` a number of the component (null for empty sets). ``rates=EXACT`` samples nothing.
    Jobs run here; only counts come to the driver, and scratch tables go as they are read.
    """
    sketched = written(sketches(docs, percent, width, rates), "join-sketches")
    sampled = written(
        sketched.where("n > 0").groupBy("s1", "s2").agg(
            F.min("doc_id").alias("least_id"), F.min_by("tie", F.struct("doc_id", "tie")).alias("any_tie"),
            F.min_by("doc_id", F.struct("doc_id", "tie")).alias("any_id"),
            *(F.first(c).alias(c) for c in ("n", "step", "m", "m_next", "sample")))
        .withColumn("node", F.monotonically_increasing_id()), "join-sampled")
    rows = written(sketched.select("doc_id", "tie", "n", "s1", "s2"), "join-rows")
    drop_files(sketched)
    nodes = written(sampled.select("node", "s1", "s2", "least_id", "any_id", "any_tie", "n"), "join-nodes")
    edges = candidate_edges(sampled, percent, rates)
    drop_files(sampled)
    grouped = connected_components(edges)
    drop_files(edges)
    candidates = written(grouped.join(nodes, "node").select(
        "component", "node", F.col("any_id").alias("doc_id"), F.col("any_tie").alias("tie"), "n"), "join-candidates")
    drop_files(grouped)
    linked = connected_components(links(docs, candidates, percent, chunk, width))
    named = nodes.select("node", "s1", "s2", "least_id").join(linked, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "component").select("s1", "s2", "component", "component_id")
    found = written(rows.join(named, ["s1", "s2"], "left").select(
        "doc_id", "tie", F.col("n").cast("long").alias("n_shingles"), "component",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")), "join-found")
    for done in (rows, nodes, candidates, linked):
        drop_files(done)
    return found


def one_of_each(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, rates: tuple = RATES) -> DataFrame:
    """``docs`` with one row of each component: the least doc_id (null last), then the least hash of the
    text. Rows without shingles all stay. All columns are kept."""
    found = jaccard_components(docs.select("doc_id", "text"), percent, width=width, rates=rates)
    me = F.struct("doc_id", "tie")
    kept = (found.where("component is not null").groupBy("component")
            .agg(F.min_by(me, F.struct(F.col("doc_id").isNull(), "doc_id", "tie")).alias("me"))
            .select("me.*", F.lit(True).alias("__once")))
    empty = found.where("component is null").select("doc_id", "tie", F.lit(False).alias("__once")).distinct()
    kept = kept.unionByName(empty).select(*row_key("doc_id", F.col("tie")), "__once")
    rows = with_copy(packed(docs), of=f"{ROW}.").join(kept, ROW_KEY)
    return unpacked(rows.where(~F.col("__once") | (F.col("__copy") == 1)))
