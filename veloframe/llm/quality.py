"""Quality scores from supervised subword embeddings.

A text's features are its words, the pairs of neighbouring words, and the character n-grams of its words
(of 2 to 5 bytes, with a space for each edge of a word), hashed into ``BUCKETS``; a word equal to the one
before it gives one feature more, the same for all words. Every bucket has a learned vector; a text's
vector is the mean of its features' vectors, and a softmax layer over it gives the score. Both are
trained together by stochastic gradient descent in numpy, a text a step, with a falling rate.

The layer is linear up to the softmax, so a bucket counts in a score by one number, its vector's share of
the difference of the two classes. A trained model carries these numbers as integers (2^-20 each): sums
are exact, so scores depend neither on batches nor on the order of rows. Hashes are polynomial and taken
for all words of a portion at once.

Words are runs of characters other than space, tab, \\n, \\v, \\f and \\r. Cases: null, empty and blank
texts have no features and get the score of the layer's bias, as does every text where the sample has
labels of one kind only or none (the bias is then 0); very long texts are scored whole; equal texts have
equal scores; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veloframe.llm.common import texts, written

THRESHOLD = 0.3
#: Documents of each label that the model learns from, at most, and their UTF-8 bytes together.
SAMPLE_PER_LABEL, SAMPLE_BYTES = 1500, 12_000_000
BUCKETS, SIZE, GRAMS = 1 << 18, 8, (2, 3, 4, 5)
STEPS, RATE = 12_000, 0.25
UNIT = 1 << 20
#: Bytes of text whose features are held at one time (a longer text is taken alone).
PORTION_BYTES = 1_000_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
_SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)
#: The feature of a word equal to the one before it.
AGAIN = 0


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def bucket(value: np.ndarray, salt: int) -> np.ndarray:
    """Buckets of hashes, other than ``AGAIN``."""
    x = (value + np.uint64(salt)) * _MULTIPLIER
    x = ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> _SHIFT
    return np.maximum(x, np.uint64(AGAIN + 1)).astype(np.int64)


def features(documents: Sequence[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) arrays of all features of the texts, a pair of arrays for each kind."""
    split = [x.split() for x in documents]
    counts = np.array([len(x) for x in split], np.int64)
    if not counts.sum():
        return []
    raw = np.frombuffer(b" " + b" ".join(w for own in split for w in own) + b" ", np.uint8)
    gap = raw == 32
    edges = np.flatnonzero(gap)
    first, last = edges[:-1] + 1, edges[1:]
    owner = np.repeat(np.arange(len(split)), counts)
    running = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(raw.astype(np.uint64) * powers(_MULTIPLIER, len(raw)), out=running[1:])
    word = (running[last] - running[first]) * powers(_INVERSE, len(raw))[first]
    out = [(owner, bucket(word, 1))]
    pair = owner[1:] == owner[:-1]
    out.append((owner[1:][pair], bucket(word[:-1][pair] * np.uint64(31) ^ word[1:][pair], 2)))
    again = pair & (word[1:] == word[:-1])
    out.append((owner[1:][again], np.full(int(again.sum()), AGAIN, np.int64)))
    at_byte = owner[np.minimum(np.cumsum(gap) - 1, len(owner) - 1)]  # a gap counts with the word after it
    gaps = np.concatenate([[0], np.cumsum(gap)])
    hashed = raw.astype(np.uint64)
    for n in range(2, max(GRAMS) + 1):
        hashed = hashed[:-1] * _MULTIPLIER + raw[n - 1:]
        if n in GRAMS:
            # a window may begin and end with a gap, but have none within
            end = np.arange(n, len(raw) + 1)
            inside = np.flatnonzero(gaps[end - 1] == gaps[end - n + 1])
            out.append((at_byte[inside], bucket(hashed[inside], 10 + n)))
    return out


def bags(documents: Sequence[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its buckets, each once, and their shares of its features."""
    out = []
    for x in documents:
        found = features([x])
        b, n = np.unique(np.concatenate([k for _, k in found]), return_counts=True) if found else (
            np.zeros(0, np.int64), np.zeros(0))
        out.append((b, (n / max(1, n.sum())).astype(np.float32)))
    return out


@dataclass
class Model:
    """Vectors of the buckets, the softmax layer, and the buckets' numbers in a score."""

    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    def weights(self) -> np.ndarray:
        return np.rint(self.vectors.astype(np.float64) @ (self.layer[1] - self.layer[0]) * UNIT).astype(np.int32)

    def scorer(self) -> "Scorer":
        return Scorer(self.weights(), float(self.bias[1] - self.bias[0]))


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def scores(self, documents: Sequence[bytes]) -> np.ndarray:
        """Probability of label 1 of each text."""
        total, n = np.zeros(len(documents), np.int64), np.zeros(len(documents), np.int64)
        for owner, b in features(documents):
            value = np.concatenate([[0], np.cumsum(self.weights[b], dtype=np.int64)])
            ends = np.searchsorted(owner, np.arange(len(documents) + 1))
            total += value[ends[1:]] - value[ends[:-1]]
            n += np.diff(ends)
        return 1 / (1 + np.exp(-(self.bias + total / np.maximum(n, 1) / UNIT)))


def fit(documents: Sequence[bytes], labels: Sequence[int], steps: int = STEPS, rate: float = RATE,
        seed: int = 7) -> Model:
    """Vectors and softmax layer by gradient descent: ``steps`` texts, in a drawn order per pass."""
    draw = np.random.default_rng(seed)
    y = np.asarray(labels, np.int64)
    vectors = draw.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE)).astype(np.float32)
    layer, bias = draw.uniform(-1, 1, (2, SIZE)), np.zeros(2)
    if len(set(labels)) < 2:
        return Model(vectors, np.zeros((2, SIZE)), bias)
    found = bags(documents)
    order = np.concatenate([draw.permutation(len(found)) for _ in range(-(-steps // len(found)))])[:steps]
    for done, k in enumerate(order):
        now = rate * (1 - done / steps)
        b, share = found[k]
        mean = share @ vectors[b]
        z = layer @ mean + bias
        p = np.exp(z - z.max())
        miss = -p / p.sum()
        miss[y[k]] += 1
        back = miss @ layer
        layer += now * np.outer(miss, mean)
        bias += 0.1 * now * miss
        # steps by share, scaled so that the text's vector moves by now * back
        vectors[b] += np.outer(now / max(share @ share, 1e-9) * share, back).astype(np.float32)
    return Model(vectors, layer, bias)


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learned from; a null id has no label."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sampled(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL,
            most: int = SAMPLE_BYTES) -> list[tuple[bytes, int]]:
    """(text, label) of at most ``per_label`` labelled documents of each kind that are not held out, whose
    texts together have ``most`` bytes at most for each kind; in the order of a hash of doc_id.

    A document labelled both ways counts as 0. Of rows that share a doc_id the greatest text stands for all.
    Texts are measured on Spark; the driver gets ids and sizes of the draw, then its texts.
    """
    usable = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
              .withColumn("draw", F.xxhash64("doc_id")))
    with_text = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    present = usable.join(with_text.select("doc_id"), "doc_id", "left_semi")
    drawn = [present.where(F.col("label") == k).orderBy("draw", "doc_id").limit(per_label) for k in (0, 1)]
    rows = written(with_text.join(F.broadcast(drawn[0].unionByName(drawn[1])), "doc_id")
                   .groupBy("doc_id", "label", "draw").agg(F.max("text").alias("text")), "quality-sample")
    left, kept = {0: most, 1: most}, []
    for r in sorted(rows.select("draw", "doc_id", "label", F.octet_length("text").alias("n")).collect()):
        if r["n"] <= left[r["label"]]:
            left[r["label"]] -= r["n"]
            kept.append((r["doc_id"],))
    ids = docs.sparkSession.createDataFrame(kept, rows.select("doc_id").schema)
    found = rows.join(F.broadcast(ids), "doc_id").select("draw", "doc_id", "text", "label").collect()
    return [(text.encode(), label) for _, _, text, label in sorted(found)]


def train(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Model:
    """Fit on the documents of ``sampled``."""
    rows = sampled(docs, labels, per_label)
    return fit([t for t, _ in rows], [k for _, k in rows])


def portions(column: pa.Array) -> Iterator[list[bytes]]:
    """The texts in turn, about ``PORTION_BYTES`` at a time."""
    own, n = [], 0
    for raw in texts(column):
        own.append(raw)
        n += len(raw)
        if n >= PORTION_BYTES:
            yield own
            own, n = [], 0
    if own:
        yield own


def quality(text: Column, model: Model) -> Column:
    """Probability that a text has label 1."""
    scorer = model.scorer()

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0), *(scorer.scores(x) for x in portions(column))]), pa.float64())

    return scored(text)
