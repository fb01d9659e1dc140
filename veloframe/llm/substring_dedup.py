"""Substring dedup: suffix automata of reference shards, matched by documents' segments.

A word is removed when a window of ``WINDOW`` words that covers it also starts
in an earlier document. Equal windows have the same least word gram, so every
document is cut into segments of consecutive windows with one least gram, and
that gram is the segment's shard key: all places where a window occurs meet in
one shard. Per shard, the distinct segments of grams that several documents
hold form the reference; a suffix automaton over their words keeps, per state,
the first document of its occurrences, and each segment is run through it: a
match of at least a window's length names the window's first document.

One pass over the texts lists their segments by digest, without words; words are
cut once per distinct segment, from its first document. Scratch tables go as
soon as the next one is written.

Automata of all shards cannot be broadcast, as they grow with the corpus, so
segments go to the automata. A shard whose reference is larger than
``SHARD_WORDS`` (a gram of a very common line) would not fit one task: its
windows are compared by digest, dealt by digest, which finds the same firsts.

Cases: a null or empty text has no words; texts shorter than a window lose
none; of equal texts the first stays and longer ones go whole; rows of one
doc_id are not earlier than each other; a null doc_id comes after all others;
very long texts are read whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veloframe.llm.common import small, texts, written
from veloframe.sources.catalog import drop_files

WINDOW, GRAM = 50, 20
#: Words of a shard's reference that one automaton may hold.
SHARD_WORDS = 200_000
#: Segments of one task's shards, about.
TASK_SEGMENTS = 20_000
LAST = 2 ** 63 - 1
MIX = 0x9E3779B97F4A7C15


def least_grams(words: list[bytes], window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """The least gram hash in each window of ``words``."""
    n = len(words)
    if n < window:
        return np.empty(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    g = h[:n - gram + 1].copy()
    for k in range(1, gram):
        g = g * np.uint64(MIX) + h[k:n - gram + 1 + k]
    g = (g ^ (g >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(29)
    span, width = 1, window - gram + 1
    while span < width:  # least of ``span`` grams from each place, doubled up to ``width``
        step = min(span, width - span)
        g = np.minimum(g[:len(g) - step], g[step:])
        span += step
    return g.view(np.int64)


def segments(words: list[bytes], window: int = WINDOW, gram: int = GRAM) -> list[tuple[int, int, int]]:
    """(key, start, end) of the runs of windows with one least gram, ``end`` after their last word."""
    keys = least_grams(words, window, gram)
    if not len(keys):
        return []
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    ends = np.append(starts[1:], len(keys)) + window - 1
    return list(zip(keys[starts].tolist(), starts.tolist(), ends.tolist(), strict=True))


class Automaton:
    """Suffix automaton of several word sequences; ``first`` is the least owner of a state's occurrences."""

    def __init__(self) -> None:
        self.length, self.link, self.next, self.first = [0], [-1], [{}], [LAST]

    def state(self, length: int, link: int, moves: dict, first: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(moves)
        self.first.append(first)
        return len(self.length) - 1

    def extend(self, last: int, c: int, owner: int) -> int:
        length, link, moves = self.length, self.link, self.next
        if (q := moves[last].get(c)) is not None:
            if length[q] != length[last] + 1:
                q = self.split(last, c, q)
        else:
            q = self.state(length[last] + 1, 0, {}, LAST)
            p = last
            while p >= 0 and c not in moves[p]:
                moves[p][c] = q
                p = link[p]
            if p >= 0:
                r = moves[p][c]
                link[q] = r if length[r] == length[p] + 1 else self.split(p, c, r)
        if owner < self.first[q]:
            self.first[q] = owner
        return q

    def split(self, p: int, c: int, q: int) -> int:
        copy = self.state(self.length[p] + 1, self.link[q], dict(self.next[q]), LAST)
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def settle(self, window: int) -> None:
        """Hand owners on to shorter suffixes; ``top`` is the state of a state's last ``window`` words."""
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        for s in reversed(order):
            if self.first[s] < self.first[self.link[s]]:
                self.first[self.link[s]] = self.first[s]
        self.top = list(range(len(self.length)))
        for s in order:
            if self.length[self.link[s]] >= window:
                self.top[s] = self.top[self.link[s]]

    def firsts(self, word_ids: list[int], window: int) -> list[int]:
        """The first owner of each window of a sequence; LAST where no owner has it."""
        s, matched, out = 0, 0, []
        for k, c in enumerate(word_ids):
            while s and c not in self.next[s]:
                s = self.link[s]
                matched = self.length[s]
            if c in self.next[s]:
                s, matched = self.next[s][c], matched + 1
            if k >= window - 1:
                out.append(self.first[self.top[s]] if matched >= window else LAST)
        return out


def first_owners(reference: list[tuple[bytes, int]], window: int = WINDOW) -> list[list[int]]:
    """Of each (segment, owner): the first owner of each of its windows in the reference."""
    ids: dict[bytes, int] = {}
    words = [[ids.setdefault(w, len(ids)) for w in raw.split(b" ")] for raw, _ in reference]
    automaton = Automaton()
    for sequence, (_, owner) in zip(words, reference, strict=True):
        last = 0
        for c in sequence:
            last = automaton.extend(last, c, owner)
    automaton.settle(window)
    return [automaton.firsts(sequence, window) for sequence in words]


def covered(n: int, starts: list[int], window: int = WINDOW) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts at one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    at = np.unique(np.array(starts, np.int64))
    edge[at] += 1
    np.subtract.at(edge, at + window, 1)
    return np.cumsum(edge[:n]) > 0


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the order of ids (nulls last) and a hash of the text, which name a text's rows."""
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord"),
                       F.xxhash64("text").alias("tie"), F.coalesce("text", F.lit("")).alias("text"))


SEGMENTS = "array<struct<key:long,d1:long,d2:long,start:int,n:int>>"


def segments_of(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Per row its order, text identity and segments: key, digest of the words, first word, number of words."""
    names = ["key", "d1", "d2", "start", "n"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, places, digests = [], [], []
            for raw in texts(batch.column("text")):
                words = raw.split()
                own = segments(words, window, gram)
                counts.append(len(own))
                places += own
                digests += [xxhash.xxh3_128_digest(b" ".join(words[a:b])) for _, a, b in own]
            at = np.array(places, np.int64).reshape(-1, 3)
            d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            rows = pa.StructArray.from_arrays(
                [pa.array(at[:, 0]), pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(at[:, 1].astype(np.int32)),
                 pa.array((at[:, 2] - at[:, 1]).astype(np.int32))], names=names)
            ends = pa.array(np.cumsum([0, *counts], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.ListArray.from_arrays(ends, rows)],
                                             names=["ord", "tie", "crc", "size", "segments"])

    return keyed(docs).select("ord", "tie", F.crc32(F.col("text").cast("binary")).alias("crc"),
                              F.octet_length("text").cast("long").alias("size"), "text").mapInArrow(
        cut, f"ord long, tie long, crc long, size long, segments {SEGMENTS}")


def words_of(docs: DataFrame, owners: DataFrame) -> DataFrame:
    """(key, d1, d2, owner, big, words) of each of ``owners``: the words once per distinct segment, cut from
    the text that holds it first."""
    wanted = owners.groupBy("ord", "tie").agg(F.collect_list(F.struct("key", "d1", "d2", "start", "n", "big")).alias("own"))
    once = F.row_number().over(Window.partitionBy("ord", "tie").orderBy("ord"))
    rows = (keyed(docs).select("ord", "tie", "text").withColumn("nth", once).where("nth = 1")
            .join(wanted, ["ord", "tie"]).select("ord", "text", "own"))
    names = ["key", "d1", "d2", "owner", "big", "words"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out: list[list] = [[] for _ in names]
            for o, raw, own in zip(batch.column(0).to_pylist(), texts(batch.column(1)), batch.column(2).to_pylist(),
                                   strict=True):
                words = raw.split()
                for x in own:
                    joined = b" ".join(words[x["start"]:x["start"] + x["n"]])
                    for column, value in zip(out, (x["key"], x["d1"], x["d2"], o, x["big"], joined), strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 4 + [pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=names)

    return rows.mapInArrow(cut, "key long, d1 long, d2 long, owner long, big boolean, words binary")


def firsts_by_automaton(reference: DataFrame, rows: int, window: int) -> DataFrame:
    """(key, d1, d2, firsts): the first owner of each window of the distinct segments."""
    def match(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("owner", "ascending")])
        keys, owners = table.column("key").to_pylist(), table.column("owner").to_pylist()
        words, out = table.column("words").to_pylist(), []
        for _, group in groupby(range(len(keys)), keys.__getitem__):
            out += first_owners([(words[k], owners[k]) for k in group], window)
        return table.select(["key", "d1", "d2"]).append_column("firsts", pa.array(out, pa.list_(pa.int64())))

    shards = F.pmod("key", F.lit(max(8, -(-rows // TASK_SEGMENTS))))
    return reference.groupBy(shards.alias("shard")).applyInArrow(
        match, "key long, d1 long, d2 long, firsts array<long>")


def firsts_by_digest(reference: DataFrame, window: int) -> DataFrame:
    """The same for segments of shards too large for one automaton."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, raw in enumerate(batch.column("words").to_pylist()):
                words = raw.split(b" ")
                n = len(words) - window + 1
                digests = np.frombuffer(b"".join(
                    xxhash.xxh3_128_digest(b" ".join(words[a:a + window])) for a in range(n)), np.int64).reshape(-1, 2)
                same = [pa.array([batch.column(c)[k].as_py()] * n, pa.int64()) for c in ("key", "d1", "d2", "owner")]
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(range(n), pa.int32()), pa.array(digests[:, 0]), pa.array(digests[:, 1])],
                    names=["key", "d1", "d2", "owner", "at", "w1", "w2"])

    windows = reference.mapInArrow(cut, "key long, d1 long, d2 long, owner long, at int, w1 long, w2 long")
    least = windows.groupBy("w1", "w2").agg(F.min("owner").alias("first"))
    return (windows.join(least, ["w1", "w2"]).groupBy("key", "d1", "d2")
            .agg(F.sort_array(F.collect_list(F.struct("at", "first"))).alias("x"))
            .select("key", "d1", "d2", F.col("x.first").alias("firsts")))


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS
                     ) -> DataFrame:
    """(ord, tie, starts, whole): of each text that repeats something, the starts of its windows that an
    earlier document holds; ``whole`` where an earlier text is equal, and no starts are listed.

    ``docs``: (doc_id, text). Jobs run here; only counts come to the driver.
    """
    place = ["key", "d1", "d2"]
    rows = written(segments_of(docs, window, gram), "dedup-rows")
    equal = ["tie", "crc", "size"]
    leaders = rows.groupBy(*equal).agg(F.min("ord").alias("leader"))
    copies = written(rows.select("ord", *equal).join(leaders, equal).where("ord > leader").select("ord", "tie").distinct(),
                     "dedup-copies")
    posted = rows.join(leaders, equal).where("ord = leader").select("ord", "tie", F.inline("segments"))
    several = (posted.groupBy("key").agg(F.min("ord").alias("a"), F.max("ord").alias("b"))
               .where("a < b").select("key"))
    places = written(posted.join(several, "key", "left_semi").select(*place, "ord", "tie", "start", "n").distinct(),
                     "dedup-places")
    drop_files(rows)
    first = places.groupBy(*place).agg(F.min(F.struct("ord", "tie", "start", "n")).alias("o")).select(*place, "o.*")
    large = first.groupBy("key").agg(F.sum("n").alias("all")).where(F.col("all") > shard_words).select(
        "key", F.lit(True).alias("big"))
    owners = written(first.join(large, "key", "left").fillna(False, ["big"]), "dedup-owners")
    words = written(words_of(docs, owners), "dedup-words")
    reference = words.select(*place, "owner", "words")
    firsts = (firsts_by_automaton(reference.where(~words["big"]), owners.count(), window)
              .unionByName(firsts_by_digest(reference.where(words["big"]), window)))
    here = F.filter(F.transform("firsts", lambda f, k: F.when(f < F.col("ord"), F.col("start") + k)),
                    lambda x: x.isNotNull())
    repeats = (places.join(firsts, place).select("ord", "tie", here.alias("starts"))
               .where(F.size("starts") > 0).groupBy("ord", "tie").agg(F.flatten(F.collect_list("starts")).alias("starts")))
    found = written(repeats.withColumn("whole", F.lit(False)).unionByName(
        copies.select("ord", "tie", F.array().cast("array<int>").alias("starts"), F.lit(True).alias("whole"))),
        "dedup-repeats")
    for done in (copies, places, owners, words):
        drop_files(done)
    return found


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of each row of ``docs`` (doc_id, text); ``kept`` is the text of
    the words that stay, joined by one space."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    repeats = repeated_windows(docs, window, gram, shard_words)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            n_words, n_removed, kept = [], [], []
            for raw, starts, whole in zip(texts(batch.column("text")), batch.column("starts").to_pylist(),
                                          batch.column("whole").to_pylist(), strict=True):
                words = raw.split()
                if whole:
                    left = words if len(words) < window else []
                elif starts:
                    gone = covered(len(words), starts, window)
                    left = [w for w, out in zip(words, gone.tolist(), strict=True) if not out]
                else:
                    left = words
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return keyed(docs).join(repeats, ["ord", "tie"], "left").select("doc_id", "text", "starts", "whole").mapInArrow(
        clean, f"doc_id {kind}, n_words long, n_removed long, kept string")
