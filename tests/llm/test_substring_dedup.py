import hashlib
import random
from collections import Counter

import pytest

from veloframe.llm import substring_dedup as D
from veloframe.llm.queries import op3_substring_dedup

from .conftest import SCHEMA, document, sentence


def brute(docs, window=50):
    """(doc_id, n_words, n_removed, digest) by comparing windows of all rows; null ids come last."""
    key = lambda i: float("inf") if i is None else i
    firsts = {}
    words = [(key(i), i, (t or "").encode().split()) for i, t in docs]
    for k, _, w in words:
        for a in range(len(w) - window + 1):
            x = tuple(w[a:a + window])
            firsts[x] = min(firsts.get(x, k), k)
    out = Counter()
    for k, i, w in words:
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if firsts[tuple(w[a:a + window])] < k:
                gone[a:a + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def result(df):
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect())


def overlapping(n=120, seed=0):
    """Documents out of shared passages of all lengths, with a common line in a third of them."""
    r = random.Random(seed)
    passages = [sentence(r, r.randint(20, 160), 300) for _ in range(15)]
    line = sentence(r, 30, 300)
    rows = []
    for i in range(n):
        parts = [r.choice((r.choice(passages), sentence(r, r.randint(1, 80), 300))) for _ in range(r.randint(1, 5))]
        if i % 3 == 0:
            parts.insert(r.randrange(len(parts) + 1), line)
        rows.append((i * 7 % n, "\n".join(parts)))
    return rows


def test_automaton_equals_brute_force():
    r = random.Random(5)
    for _ in range(200):
        reference = [(b" ".join(str(r.randrange(3)).encode() for _ in range(r.randint(6, 14))), r.randrange(9))
                     for _ in range(r.randint(1, 6))]
        got = D.first_owners(reference, 6)
        firsts = {}
        for raw, owner in reference:
            w = raw.split()
            for a in range(len(w) - 5):
                firsts[tuple(w[a:a + 6])] = min(owner, firsts.get(tuple(w[a:a + 6]), owner))
        for (raw, _), own in zip(reference, got, strict=True):
            w = raw.split()
            if len(reference) > 1:
                assert own == [firsts[tuple(w[a:a + 6])] for a in range(len(w) - 5)]


def test_equal_windows_have_equal_keys():
    r = random.Random(1)
    a, shared, b = (sentence(r, n, 50).encode().split() for n in (70, 50, 33))
    keys = D.least_grams(a + shared + b)
    assert len(keys) == 104 and keys[70] == D.least_grams(shared)[0]
    covered = [k for _, s, e in D.segments(a + shared + b) for k in range(s, e - 49)]
    assert covered == list(range(104))


def test_query_on_edge_rows(spark, edge_docs, folder):
    want = brute([(r["doc_id"], r["text"]) for r in edge_docs.collect()])
    assert result(op3_substring_dedup(spark, folder(documents=edge_docs))) == want


@pytest.mark.parametrize("shard_words", [D.SHARD_WORDS, 200])
def test_overlapping_passages_and_large_shards(spark, shard_words):
    rows = overlapping()
    docs = spark.createDataFrame([document(i, t) for i, t in rows], SCHEMA).repartition(3)
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest())
                  for r in D.dedup(docs, shard_words=shard_words).collect())
    assert got == brute(rows)
    assert sum(n for _, _, n, _ in got) > 0


def test_empty_table(spark, no_docs, folder):
    assert op3_substring_dedup(spark, folder(documents=no_docs)).count() == 0
