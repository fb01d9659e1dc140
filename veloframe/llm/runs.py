"""Periodic runs of words: maximal stretches that repeat a period at least four times.

Longest common extensions (LCE) of two places come from a difference cover: of the places modulo 31
only those in ``COVER`` are sampled, and any two places reach sampled ones by the same shift below 31.
A query compares that many words and, where all agree, takes the minimum of the sampled suffixes' LCP
array between their ranks, from a sparse table. Sampled suffixes are sorted by their first 31 words and
then by doubling, as the suffix 31 * 2^k words on is sampled, too. Only documents in which some query
gets past the compared words are sorted.

A run of period p and four periods or more holds some grid place i (a multiple of 3p) together with
i + p. So for each p the grid is visited, n / 3p places, and the extensions to both sides of (i, i + p)
give the maximal stretch. The whole grid of a text has n ln n / 3 places and is visited in portions.

Words are runs of characters other than space, tab, \\n, \\v, \\f and \\r. Cases: null, empty and blank
texts have no words and no runs; very long texts are searched whole, with memory in proportion to the
text; repeated rows are worked out each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from veloframe.llm.common import texts

#: A perfect difference set: each nonzero difference modulo ``MODULUS`` occurs once.
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)
#: A run repeats its period this often at least, and has ``LEAST_WORDS`` words at least.
REPEATS, LEAST_WORDS = 4, 6
#: Grid places looked at, and words held, at one time (a longer text is taken alone).
GRID_PLACES, PORTION_WORDS = 1_000_000, 200_000

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RUN_TYPE = "struct<n_words:long,runs:array<struct<start:long,length:long,period:long>>,collapsed:string>"


def shifts() -> np.ndarray:
    """The least shift that brings two residues into the cover."""
    out = np.full((MODULUS, MODULUS), MODULUS, np.int64)
    for d in range(MODULUS - 1, -1, -1):
        at = [(c - d) % MODULUS for c in COVER]
        out[np.ix_(at, at)] = d
    return out


SHIFT = shifts()
SAMPLED = np.isin(np.arange(MODULUS), COVER)


def starts_of(flags: np.ndarray) -> np.ndarray:
    """For each place, the last flagged place up to it."""
    return np.maximum.accumulate(np.where(flags, np.arange(len(flags)), 0))


class SampledSuffixes:
    """Sorted suffixes of the sampled places of some documents, with a sparse table over their LCP array.

    ``words`` holds a sentinel after each document, so that suffixes of one document differ within it.
    """

    def __init__(self, words: np.ndarray, document: np.ndarray, wanted: np.ndarray):
        places = np.flatnonzero(wanted[document] & SAMPLED[np.arange(len(words)) % MODULUS])
        self.slot = np.full(len(words), -1, np.int64)
        self.slot[places] = np.arange(len(places))
        self.places, self.words = places, words
        first = np.ones(len(places), bool)
        first[1:] = document[places[1:]] != document[places[:-1]]
        rank, levels = starts_of(first), []
        tied = self.still_tied(np.arange(len(places)), rank)
        for k in range(MODULUS):
            if len(tied):
                tied = self.refine(tied, rank, words[places[tied] + k])
        span = MODULUS
        while len(tied):
            levels.append((span, rank.copy()))
            tied = self.refine(tied, rank, levels[-1][1][self.slot[places[tied] + span]])
            span *= 2
        self.rank = rank
        order = np.empty(len(places), np.int64)
        order[rank] = np.arange(len(places))
        self.table = self.minima(self.adjacent(places[order], levels, first))

    @staticmethod
    def still_tied(members: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Members, ordered by group, of groups of two or more."""
        same = group[members][1:] == group[members][:-1]
        keep = np.zeros(len(members), bool)
        keep[1:] |= same
        keep[:-1] |= same
        return members[keep]

    def refine(self, tied: np.ndarray, rank: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Splits groups (named by their first rank) by ``key``; returns the members still tied."""
        order = np.lexsort((key, rank[tied]))
        tied, key = tied[order], key[order]
        old = rank[tied]
        new_group = np.ones(len(tied), bool)
        new_group[1:] = old[1:] != old[:-1]
        new = new_group.copy()
        new[1:] |= key[1:] != key[:-1]
        rank[tied] = old + starts_of(new) - starts_of(new_group)
        return self.still_tied(tied, rank)

    def adjacent(self, ordered: np.ndarray, levels: list, first: np.ndarray) -> np.ndarray:
        """LCP of each sorted suffix with the one before it; 0 at a document's first."""
        at = np.flatnonzero(~first)
        a, b = ordered[at - 1], ordered[at]
        n = np.zeros(len(at), np.int64)
        for span, rank in reversed(levels):
            n += np.where(rank[self.slot[a + n]] == rank[self.slot[b + n]], span, 0)
        alive = np.arange(len(at))
        while len(alive):
            alive = alive[self.words[a[alive] + n[alive]] == self.words[b[alive] + n[alive]]]
            n[alive] += 1
        out = np.zeros(len(ordered), np.int64)
        out[at] = n
        return out

    @staticmethod
    def minima(lcp: np.ndarray) -> list[np.ndarray]:
        table, width = [lcp.astype(np.int32)], 1
        while 2 * width <= len(lcp):
            table.append(np.minimum(table[-1][:-width], table[-1][width:]))
            width *= 2
        return table

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """LCE of pairs of different sampled places of the same document."""
        x, y = self.rank[self.slot[a]], self.rank[self.slot[b]]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp(high - low)[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = level == k
            row = self.table[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return out


def extensions(words: np.ndarray, document: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from ``i`` and from ``j`` on agree, for i < j of the same document."""
    shift = SHIFT[i % MODULUS, j % MODULUS]
    out, alive, far = np.zeros(len(i), np.int64), np.arange(len(i)), []
    for k in range(MODULUS):
        reached = shift[alive] == k
        far.append(alive[reached])
        alive = alive[~reached]
        alive = alive[words[i[alive] + k] == words[j[alive] + k]]
        out[alive] = k + 1
        if not len(alive):
            break
    at = np.concatenate(far)
    at = at[words[i[at] + out[at]] == words[j[at] + out[at]]]
    if len(at):
        wanted = np.zeros(document[-1] + 1, bool)
        wanted[document[i[at]]] = True
        suffixes = SampledSuffixes(words, document, wanted)
        out[at] += suffixes.extension(i[at] + shift[at], j[at] + shift[at])
    return out


def grid(lengths: np.ndarray, base: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of all documents' harmonic grids, in portions."""
    periods = lengths // REPEATS
    which = np.repeat(np.arange(len(lengths)), periods)
    period = np.arange(len(which)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = (REPEATS - 1) * period
    count = (lengths[which] - period - 1) // step + 1
    ends = np.cumsum(count)
    at = 0
    while at < len(which):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GRID_PLACES, "right")))
        n = count[at:to]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(base[which[at:to]], n) + inner * np.repeat(step[at:to], n), np.repeat(period[at:to], n)
        at = to


def find_runs(documents: Sequence[Sequence[bytes]]) -> list[np.ndarray]:
    """Rows (start, length, period) of each document's runs, by start, then period."""
    known: dict[bytes, int] = {}
    lengths = np.array([len(d) for d in documents], np.int64)
    base = np.cumsum(lengths + 1) - lengths - 1
    words = np.full(int((lengths + 1).sum()) + MODULUS, -1, np.int64)  # -1: a document's sentinel
    for at, own in zip(base, documents, strict=True):
        words[at:at + len(own)] = [known.setdefault(w, len(known)) for w in own]
    document = np.repeat(np.arange(len(documents)), lengths + 1)
    document = np.concatenate([document, np.full(MODULUS, len(documents))])  # padding, a document of its own
    places, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, p in grid(lengths, base):
        same = words[i] == words[i + p]
        places.append(i[same])
        periods.append(p[same])
    i, p = np.concatenate(places), np.concatenate(periods)
    forward = extensions(words, document, i, i + p)
    ends = base + lengths
    mirror = words.copy()
    total = int((lengths + 1).sum())
    own = document[:total]
    inside = np.arange(total) < ends[own]
    mirror[:total][inside] = words[(base[own] + ends[own] - 1 - np.arange(total))[inside]]
    back = base[document[i]] + ends[document[i]] - i
    backward = extensions(mirror, document, back - p, back)
    start, length = i - backward, backward + p + forward
    long_enough = length >= np.maximum(LEAST_WORDS, REPEATS * p)
    start, length, p = start[long_enough], length[long_enough], p[long_enough]
    order = np.lexsort((p, length, start))
    start, length, p = start[order], length[order], p[order]
    least = np.ones(len(p), bool)  # a stretch's smallest period
    least[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, p = start[least], length[least], p[least]
    which = document[start]
    rows = np.stack([start - base[which], length, p], axis=1) if len(p) else np.zeros((0, 3), np.int64)
    order = np.lexsort((rows[:, 2], rows[:, 0], which))
    return np.split(rows[order], np.searchsorted(which[order], np.arange(1, len(documents))))


def collapsed(words: Sequence[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return list(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [w for w, covered in zip(words, np.cumsum(change).tolist()) if not covered]


def portions(column: pa.Array) -> Iterator[list[list[bytes]]]:
    """Word lists in turn, about ``PORTION_WORDS`` words at a time."""
    own, n = [], 0
    for raw in texts(column):
        own.append(raw.split())
        n += len(own[-1])
        if n >= PORTION_WORDS:
            yield own
            own, n = [], 0
    if own:
        yield own


def periodic_runs(text: Column) -> Column:
    """struct<n_words, runs, collapsed> of a text: its runs by start, then period, in words from 0, and its
    words, one space between, without those that repeat a run's first period."""

    @F.arrow_udf(RUN_TYPE)
    def found(column: pa.Array) -> pa.Array:
        counts, runs, kept = [], [], []
        for documents in portions(column):
            for own, rows in zip(documents, find_runs(documents), strict=True):
                counts.append(len(own))
                runs.append([{"start": a, "length": b, "period": c} for a, b, c in rows.tolist()])
                kept.append(b" ".join(collapsed(own, rows)).decode())
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(runs, RUNS), pa.array(kept, pa.string())],
            names=["n_words", "runs", "collapsed"])

    return found(text)


def most_repeated(runs: Column) -> Column:
    """Of runs by start, then period, the first with the greatest length / period; null without runs."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.reduce(runs, none, lambda best, x: F.when(
        best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best))


def made_periodic(text: Column, start: Column, parts: Column) -> Column:
    """The text's words, one space between, with those from number ``start`` % n on repeating their first
    1 + (n - start % n) div ``parts``; unchanged where ``parts`` is null or the text has no words. Makes
    texts whose runs are known."""

    @F.arrow_udf("string")
    def made(column: pa.Array, starts: pa.Array, into: pa.Array) -> pa.Array:
        out = []
        for raw, g, k in zip(texts(column), starts.to_pylist(), into.to_pylist(), strict=True):
            words = raw.split() if k is not None else []
            if words:
                a = g % len(words)
                period = 1 + (len(words) - a) // k
                tail = words[a:a + period]
                again = -(-(len(words) - a) // period)
                raw = b" ".join(words[:a] + (tail * again)[:len(words) - a])
            out.append(raw.decode())
        return pa.array(out, pa.string())

    return made(text, start, parts)
