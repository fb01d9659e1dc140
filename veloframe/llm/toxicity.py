"""Toxicity by a linear-chain conditional random field over words.

Training takes a bounded sample of labelled documents. Words are labelled
through their documents: a word, or a stem of it, that stands in many unlike
toxic documents and hardly in clean ones marks its occurrences in toxic
documents as toxic tokens. The chain learns stem weights and transitions from
these token labels; forward-backward marginals give each token's probability,
and two sums of them give the document's score.

Cases: a null or empty text has no tokens and gets the score of no evidence;
very long texts are tagged whole; equal texts get equal scores; without usable
labels of both kinds every score is 0; other columns are ignored. Only the
text enters a score.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veloframe.llm.common import texts, written

#: Labelled documents of each kind to learn from, at most.
SAMPLE_PER_LABEL = 800
#: Characters of their texts together, for each kind, at most; the driver holds twice as many. A text that would
#: exceed it is not learned from. It is five times what 800 texts of 3,000 characters take.
SAMPLE_CHARS = 12_000_000
#: Share of toxic documents that a toxic stem has to stand in, and its purity.
SUPPORT, PURITY = 0.03, 0.95
SEGMENT, PASSES, RATE, RIDGE, MOST = 64, 40, 0.3, 1e-4, 30.0
THRESHOLD = 0.7

WORD = re.compile(r"[^\W\d_]+")
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def stems(word: str) -> list[str]:
    """The word and its beginnings of three to six letters, marked apart."""
    word = word.lower()
    return [word, *(f"{word[:n]}*" for n in range(3, 7) if len(word) > n)]


@dataclass
class Chain:
    """Weights of stems, the bias, log transitions and the document score's weights."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -MOST
    moves: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))
    score: tuple[float, float, float] | None = None

    def emission(self, word: str) -> float:
        weights = self.weights
        return max(-MOST, min(MOST, self.bias + sum(weights[s] for s in stems(word) if s in weights)))


class Emissions(dict):
    """Emissions of the words met so far; starts over when it has grown large."""

    def __init__(self, chain: Chain, most: int = 100_000):
        super().__init__()
        self.chain, self.most = chain, most

    def __missing__(self, word: str) -> float:
        if len(self) >= self.most:
            self.clear()
        out = self[word] = self.chain.emission(word)
        return out


def marginals(e: np.ndarray, lengths: np.ndarray, moves) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Odds of state 1 at each (step, sequence), with the forward and backward odds.

    Sequences are columns, longest first; steps beyond a length stay untouched.
    """
    (a00, a01), (a10, a11) = np.exp(moves)
    ex, steps = np.exp(e), e.shape[0]
    live = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(steps + 1)]
    forward, backward = np.ones_like(ex), np.ones_like(ex)
    if steps:
        forward[0] = ex[0]
    for t in range(1, steps):
        k = live[t]
        r = forward[t - 1, :k]
        forward[t, :k] = ex[t, :k] * (a01 + r * a11) / (a00 + r * a10)
    for t in range(steps - 2, -1, -1):
        k = live[t + 1]
        x = ex[t + 1, :k] * backward[t + 1, :k]
        backward[t, :k] = (a10 + a11 * x) / (a00 + a01 * x)
    return forward * backward, forward, backward


def tag(documents: list[list[str]], emissions: Emissions, chain: Chain,
        cells: int = 400_000, most: int = 256) -> list[np.ndarray]:
    """The probability of each word of each document to be toxic."""
    out: list[np.ndarray] = [np.zeros(0)] * len(documents)
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    at = 0
    while at < len(order) and documents[order[at]]:
        longest = len(documents[order[at]])
        group = order[at:at + max(1, min(most, cells // longest))]
        group = [i for i in group if documents[i]]
        lengths = np.array([len(documents[i]) for i in group])
        e = np.zeros((longest, len(group)))
        for c, i in enumerate(group):
            e[:lengths[c], c] = list(map(emissions.__getitem__, documents[i]))
        odds, _, _ = marginals(e, lengths, chain.moves)
        for c, i in enumerate(group):
            o = odds[:lengths[c], c]
            out[i] = o / (1 + o)
        at += len(group)
    return out


def evidence(p: np.ndarray) -> tuple[float, float]:
    return (float(np.log1p(p.sum())), float(p.max())) if len(p) else (0.0, 0.0)


def score_of(p: np.ndarray, chain: Chain) -> float:
    if chain.score is None:
        return 0.0
    a, b, c = chain.score
    x, y = evidence(p)
    return float(1 / (1 + np.exp(-(a * x + b * y + c))))


def least_shingles(words: list[str], seeds: tuple[int, ...] = (0, 1, 2)) -> list[str]:
    """The word triples of least hash, one for each seed; unlike texts share none of them."""
    three = [" ".join(x) for x in zip(words, words[1:], words[2:], strict=False)] or [" ".join(words)]
    return [min(three, key=lambda x, seed=seed: zlib.crc32(x.encode(), seed)) for seed in seeds]


def toxic_stems(documents: list[list[str]], toxic: np.ndarray) -> set[str]:
    """Stems that stand in many toxic and hardly any clean documents; near copies count once."""
    seen: set[tuple[int, int, str]] = set()
    counts = (Counter(), Counter())
    kinds = [0, 0]
    for words, label in zip(documents, toxic, strict=True):
        marks = {(int(label), k, m) for k, m in enumerate(least_shingles(words))}
        if marks & seen:
            continue
        seen |= marks
        kinds[int(label)] += 1
        counts[int(label)].update({s for w in set(words) for s in stems(w)})
    clean, bad = counts
    least = max(3.0, SUPPORT * kinds[1])
    ratio = kinds[1] / max(kinds[0], 1)
    return {s for s, n in bad.items() if n >= least and n / (n + ratio * clean[s]) >= PURITY}


#: Stems of tokens added at one time.
STEMS_AT_ONCE = 1 << 18


def sums(place: np.ndarray, values: np.ndarray, of: np.ndarray, size: int) -> np.ndarray:
    """``np.bincount(place, values[of], size)``, a part at a time and added in the same order."""
    out = np.zeros(size)
    for at in range(0, len(place), STEMS_AT_ONCE):
        np.add.at(out, place[at:at + STEMS_AT_ONCE].astype(np.intp), values[of[at:at + STEMS_AT_ONCE]])
    return out


def fit(raw: list[str], labels: list[int]) -> Chain:
    """Train the chain and the document score on labelled texts."""
    toxic = np.array(labels) == 1
    if not toxic.any() or toxic.all():
        return Chain()
    same: dict[str, str] = {}  # one string for each word, however often it occurs
    documents = [[same.setdefault(x, x) for x in (w.lower() for w in WORD.findall(t))] for t in raw]
    marked = toxic_stems(documents, toxic)
    vocabulary: dict[str, int] = {}
    counts = Counter(s for words in documents for w in set(words) for s in stems(w))
    kept = {s for s, n in counts.items() if n >= 3}
    del same, counts
    of_word: dict[str, int] = {}
    ids_of: list[array] = []
    marks_of: list[bool] = []
    pieces: list[tuple[array, int]] = []  # the numbers of a segment's words, and the document's label
    for words, label in zip(documents, toxic, strict=True):
        for at in range(0, len(words), SEGMENT):
            numbers = array("i")
            for w in words[at:at + SEGMENT]:
                if w not in of_word:
                    s = stems(w)
                    of_word[w] = len(ids_of)
                    ids_of.append(array("i", [vocabulary.setdefault(x, len(vocabulary)) for x in s if x in kept]))
                    marks_of.append(any(x in marked for x in s))
                numbers.append(of_word[w])
            pieces.append((numbers, bool(label)))
    del of_word, kept, marked
    order = sorted(range(len(pieces)), key=lambda i: -len(pieces[i][0]))
    lengths = np.array([len(pieces[i][0]) for i in order])
    n, steps = len(order), int(lengths[0]) if len(order) else 0
    if not steps:
        return Chain()
    y, token, feature = np.zeros((steps, n)), array("i"), array("i")
    for c, i in enumerate(order):
        numbers, label = pieces[i]
        y[:lengths[c], c] = [label and marks_of[k] for k in numbers]
        for t, k in enumerate(numbers):
            token.extend([t * n + c] * len(ids_of[k]))
            feature.extend(ids_of[k])
    del pieces, ids_of, marks_of
    token, feature = np.array(token, np.int32), np.array(feature, np.int32)
    valid = np.arange(steps)[:, None] < lengths[None, :]
    pairs = valid[1:]
    w, bias, moves = np.zeros(len(vocabulary)), -3.0, np.zeros((2, 2))
    past_w, past_b, past_m = np.full(len(w), 1e-8), 1e-8, np.full((2, 2), 1e-8)
    seen_moves = np.array([[((1 - y[:-1]) * (1 - y[1:]) * pairs).sum(), ((1 - y[:-1]) * y[1:] * pairs).sum()],
                           [(y[:-1] * (1 - y[1:]) * pairs).sum(), (y[:-1] * y[1:] * pairs).sum()]])
    for _ in range(PASSES):
        e = np.clip(bias + sums(token, w, feature, steps * n).reshape(steps, n), -MOST, MOST)
        odds, forward, backward = marginals(e, lengths, moves)
        miss = np.where(valid, y - odds / (1 + odds), 0.0)
        a, x = np.exp(moves), np.exp(e[1:]) * backward[1:]
        del e, odds, backward
        cells = np.stack([np.full_like(x, a[0, 0]), a[0, 1] * x, a[1, 0] * forward[:-1], a[1, 1] * forward[:-1] * x])
        del x, forward
        cells /= cells.sum(axis=0)
        cells *= pairs
        expected = cells.sum(axis=(1, 2)).reshape(2, 2)
        del cells
        up_w = sums(feature, miss.ravel(), token, len(w)) - RIDGE * n * w
        up_b, up_m = miss.sum(), seen_moves - expected - RIDGE * n * moves
        past_w, past_b, past_m = past_w + up_w ** 2, past_b + up_b ** 2, past_m + up_m ** 2
        w += RATE * up_w / np.sqrt(past_w)
        bias += RATE * up_b / np.sqrt(past_b)
        moves += RATE * up_m / np.sqrt(past_m)
    del token, feature, y, miss, valid, pairs
    chain = Chain({s: float(w[k]) for s, k in vocabulary.items() if abs(w[k]) > 0.02}, float(bias),
                  ((moves[0, 0], moves[0, 1]), (moves[1, 0], moves[1, 1])))
    points = np.array([[*evidence(p), 1.0] for p in tag(documents, Emissions(chain), chain)])
    weight = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum()) * len(toxic)
    beta = np.zeros(3)
    for _ in range(25):  # Newton steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-points @ beta))
        slope = points.T @ (weight * (toxic - p)) - 0.1 * beta
        bend = (points * (weight * p * (1 - p))[:, None]).T @ points + 0.1 * np.eye(3)
        beta += np.linalg.solve(bend, slope)
    chain.score = tuple(float(x) for x in beta)
    return chain


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learned from; a null id has no label."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 3 == 1


def sampled(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL,
            chars: int = SAMPLE_CHARS) -> list[tuple[str, int]]:
    """(text, label) of at most ``per_label`` labelled documents of each kind that are not held out, with
    ``chars`` characters together at most, by doc_id.

    The sample is drawn by a hash of doc_id; a document with labels of both kinds counts as toxic. Of rows that
    share a doc_id the greatest text stands for all. Texts are made one each and measured on Spark, so the
    driver gets no others than those of the sample.
    """
    usable = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("label"))
              .withColumn("draw", F.xxhash64("doc_id")))
    present = usable.join(docs.where(F.col("text").isNotNull()).select("doc_id").distinct(), "doc_id", "left_semi")
    drawn = [present.where(F.col("label") == k).orderBy("draw", "doc_id").limit(per_label) for k in (0, 1)]
    sample = drawn[0].unionByName(drawn[1])
    rows = written(docs.where(F.col("text").isNotNull()).select("doc_id", "text")
                   .join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label", "draw")
                   .agg(F.max("text").alias("text")), "toxicity-sample")
    left, kept = {0: chars, 1: chars}, []
    for r in sorted(rows.select("draw", "doc_id", "label", F.char_length("text").alias("n")).collect()):
        if r["n"] <= left[r["label"]]:
            left[r["label"]] -= r["n"]
            kept.append((r["doc_id"],))
    ids = docs.sparkSession.createDataFrame(kept, rows.select("doc_id").schema)
    found = rows.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "label").collect()
    return [(text, label) for _, text, label in sorted(found)]


def train(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Chain:
    """Fit on the documents of ``sampled``."""
    rows = sampled(docs, labels, per_label)
    return fit([t for t, _ in rows], [k for _, k in rows])


def portions(raw: Iterable[str], chars: int = 1_000_000) -> Iterator[list[str]]:
    """The texts in turn, about ``chars`` characters at a time, so that few word lists are held at once."""
    own, n = [], 0
    for x in raw:
        own.append(x)
        n += len(x)
        if n >= chars:
            yield own
            own, n = [], 0
    yield own


def toxic_spans(text: str, hits: set[int]) -> list[dict[str, int]]:
    """Offsets of the words numbered in ``hits``, neighbours joined."""
    out: list[dict[str, int]] = []
    for k, m in enumerate(WORD.finditer(text) if hits else ()):
        if k in hits and k - 1 in hits:
            out[-1]["end"] = m.end()
        elif k in hits:
            out.append({"start": m.start(), "end": m.end()})
    return out


def toxicity(text: Column, chain: Chain) -> Column:
    """struct<score, n_toxic, spans> of a text; spans of toxic words in code points, neighbours joined."""

    @F.arrow_udf("struct<score:double,n_toxic:long,spans:array<struct<start:int,end:int>>>")
    def tagged(column: pa.Array) -> pa.Array:
        emissions, scores, counts, spans = Emissions(chain), [], [], []
        for raw in portions(x.decode() for x in texts(column)):
            for x, p in zip(raw, tag([WORD.findall(x) for x in raw], emissions, chain), strict=True):
                hits = set(np.flatnonzero(p >= 0.5).tolist())
                scores.append(score_of(p, chain))
                counts.append(len(hits))
                spans.append(toxic_spans(x, hits))
        return pa.StructArray.from_arrays(
            [pa.array(scores, pa.float64()), pa.array(counts, pa.int64()), pa.array(spans, SPAN_TYPE)],
            names=["score", "n_toxic", "spans"])

    return tagged(text)
