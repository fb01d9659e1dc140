import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from veloframe.llm import toxicity as X
from veloframe.llm.queries import op2_crf_toxicity

from .conftest import document


def sentence(r, n, vocabulary):
    """Words of letters, as digits are no words here."""
    return " ".join("".join("bcdfghklmn"[int(c)] for c in str(r.randrange(vocabulary))) + "a" for _ in range(n))


def labelled(n, seed=0):
    r, rows = random.Random(seed), []
    for i in range(n):
        words, toxic = sentence(r, r.randint(20, 90), 400).split(), r.random() < 0.4
        if toxic:
            for _ in range(r.randint(2, 5)):
                words.insert(r.randrange(len(words)), r.choice(("scumbag", "vileness", "vilely", "nastier")))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    e, moves = rng.normal(size=(5, 2)), ((0.3, -0.7), (-0.2, 0.9))
    lengths = np.array([5, 3])
    odds, _, _ = X.marginals(e, lengths, moves)
    for c, n in enumerate(lengths):
        weight = {}
        for path in np.ndindex(*(2,) * n):
            weight[path] = np.exp(sum(y * e[t, c] for t, y in enumerate(path))
                                  + sum(moves[a][b] for a, b in zip(path, path[1:], strict=False)))
        for t in range(n):
            p = sum(w for path, w in weight.items() if path[t]) / sum(weight.values())
            assert odds[t, c] / (1 + odds[t, c]) == pytest.approx(p)


def test_held_out_accuracy_and_offsets():
    train, test = labelled(400), labelled(200, 9)
    chain = X.fit([t for _, t, _ in train], [y for _, _, y in train])
    found = X.tag([X.WORD.findall(t) for _, t, _ in test], X.Emissions(chain), chain)
    right = [int(X.score_of(p, chain) >= X.THRESHOLD) == y for p, (_, _, y) in zip(found, test, strict=True)]
    assert sum(right) / len(right) > 0.97
    bad = {"scumbag", "vileness", "vilely", "nastier"}
    for p, (_, text, _) in zip(found, test, strict=True):
        words = X.WORD.findall(text)
        assert {w for w, q in zip(words, p, strict=True) if q >= 0.5} == {w for w in words if w in bad}


def test_query_learns_only_from_rows_not_held_out(spark, folder):
    rows = [document(i, t) for i, t, _ in labelled(300)] + [document(10_000, None), document(None, ""), document(5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, "
                                       "tie string, n int, node long, shard string, size string, found string, "
                                       "copies int, copy int, __copy int, words string")
    labels = [(i, 1, y) for i, _, y in labelled(300)] + [(None, 1, 1), (7, None, None)]
    path = folder(documents=docs, labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    out = {(r["doc_id"], r["score"], r["predicted"], r["held_out"]) for r in op2_crf_toxicity(spark, path).collect()}
    truth = {i: y for i, _, y in labelled(300)}
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in truth}
    assert all(h == held[i] for i, _, _, h in out if i in held)
    assert all(0 <= s <= 1 and p == (s >= 0.7) for _, s, p, _ in out)
    right = [p == truth[i] for i, _, p, h in out if i in truth and h]
    assert sum(right) / len(right) > 0.95
    # labels of held-out rows change nothing
    swapped = spark.read.parquet(f"{path}/labels.parquet").withColumn(
        "toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    same = X.train(spark.read.parquet(f"{path}/documents.parquet"), swapped)
    assert same == X.train(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet"))


def test_no_labels_and_empty_table(spark, edge_docs, no_docs, folder):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = folder(documents=edge_docs, labels=none)
    assert {r["score"] for r in op2_crf_toxicity(spark, path).collect()} == {0.0}
    chain = X.train(no_docs, none)
    assert no_docs.select(X.toxicity(F.col("text"), chain)).count() == 0


def test_sample_brings_one_text_of_each_id(spark, monkeypatch):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, f"text {i} {'z' * (i % 7)}") for i in range(60)]
    hot = ids[0]
    rows += [(hot, f"text {k:03}") for k in range(300)] + [(hot, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(ids[2], 0), (ids[2], 1)], "doc_id long, toxic int")
    fetched, collect = [], type(docs).collect

    def counted(df):
        out = collect(df)
        fetched.extend(r["text"] for r in out if "text" in df.columns)
        return out

    monkeypatch.setattr(type(docs), "collect", counted)
    got = X.sampled(docs, labels)
    text = {i: max(t for j, t in rows if j == i and t is not None) for i in ids}
    assert got == [(text[i], 1 if i == ids[2] else i % 2) for i in ids]
    assert sorted(fetched) == sorted(text.values())
    few = X.sampled(docs, labels, chars=50)
    assert {k for _, k in few} == {0, 1} and set(few) < set(got)
    assert all(0 < sum(len(t) for t, y in few if y == k) <= 50 for k in (0, 1))
    long_ = docs.unionByName(spark.createDataFrame([(ids[3], "zz" * 100)], "doc_id long, text string"))
    assert X.sampled(long_, labels, chars=150) and max(len(t) for t, _ in X.sampled(long_, labels, chars=150)) < 150
    assert len(X.sampled(docs, labels, per_label=3)) == 6


def test_fit_holds_each_word_once():
    """Tokens are numbers, not strings and lists of their own: the driver's memory is bounded."""
    import tracemalloc

    r = random.Random(11)
    vocabulary = [f"{''.join(r.choice('abcdefghij') for _ in range(7))}" for _ in range(3000)]
    raw = [" ".join(r.choice(vocabulary) for _ in range(1000)) for _ in range(200)]
    labels = [k % 2 for k in range(200)]
    raw = [x + " vile filth" * 5 if k else x for x, k in zip(raw, labels, strict=True)]
    tracemalloc.start()
    X.fit(raw, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 * 1000 * 240


def test_sums_equal_bincount_to_the_bit(monkeypatch):
    import numpy as np

    monkeypatch.setattr(X, "STEMS_AT_ONCE", 7)
    draw = np.random.default_rng(2)
    place, of, values = draw.integers(0, 20, 500, np.int32), draw.integers(0, 9, 500, np.int32), draw.normal(size=9)
    assert X.sums(place, values, of, 25).tobytes() == np.bincount(place, values[of], 25).tobytes()
