import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from veloframe.llm import queries, runs


def brute(words):
    """(start, length, period) of every run, from the definition."""
    n, found = len(words), {}
    for p in range(1, n // 4 + 1):
        start = 0
        while start < n:
            end = start + p
            while end < n and words[end] == words[end - p]:
                end += 1
            if min(end, n) - start >= max(6, 4 * p) and (start, end) not in found:
                found[start, end] = p
            start = max(start + 1, end - p + 1)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def contract(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if found else (None,) * 3
    milli = None if not found else 1000 * best[1] // best[2]
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    return (doc_id, len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


def test_cover_reaches_all_pairs():
    cover = set(runs.COVER)
    for a in range(runs.MODULUS):
        for b in range(runs.MODULUS):
            d = runs.SHIFT[a, b]
            assert d < runs.MODULUS and {(a + d) % runs.MODULUS, (b + d) % runs.MODULUS} <= cover


def periodic(r, n):
    """Random words with nested and broken periodic stretches."""
    out = []
    while len(out) < n:
        if r.random() < 0.5:
            out += [b"%d" % r.randrange(4) for _ in range(r.randrange(1, 12))]
        else:
            unit = [b"%d" % r.randrange(3) for _ in range(r.randrange(1, 9))]
            if r.random() < 0.3:
                unit = unit * 5 + [b"x"]
            out += unit * r.randrange(2, 9) + unit[:r.randrange(len(unit))]
    return out[:n]


def test_runs_of_random_texts():
    r = random.Random(1)
    documents = [periodic(r, r.randrange(0, 160)) for _ in range(150)] + [periodic(r, 2500), [b"a"] * 1500, [], [b"one"]]
    for own, rows in zip(documents, runs.find_runs(documents), strict=True):
        assert [tuple(x) for x in rows.tolist()] == brute(own)


def test_extensions_match_a_scan():
    r = random.Random(2)
    own = periodic(r, 3000)
    ids = {w: k for k, w in enumerate(sorted(set(own)))}
    words = np.array([ids[w] for w in own] + [-1] * (1 + runs.MODULUS))
    document = np.array([0] * (len(own) + 1) + [1] * runs.MODULUS)
    i = np.array([r.randrange(len(own) - 1) for _ in range(3000)])
    j = np.array([r.randrange(a + 1, len(own)) for a in i.tolist()])
    got = runs.extensions(words, document, i, j)
    for a, b, n in zip(i.tolist(), j.tolist(), got.tolist(), strict=True):
        assert own[a:a + n] == own[b:b + n]
        assert b + n == len(own) or own[a + n] != own[b + n]


def test_portions_do_not_change_runs(monkeypatch):
    r = random.Random(3)
    documents = [periodic(r, 400) for _ in range(10)]
    whole = [x.tolist() for x in runs.find_runs(documents)]
    monkeypatch.setattr(runs, "GRID_PLACES", 7)
    assert [x.tolist() for x in runs.find_runs(documents)] == whole
    assert [runs.find_runs([d])[0].tolist() for d in documents] == whole


def test_long_text_of_one_word():
    (rows,) = runs.find_runs([[b"a"] * 60_000])
    assert rows.tolist() == [[0, 60_000, 1]]


def test_query_against_brute_force(spark, small_dir):
    rows = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(x) for x in queries.op11_periodic_runs(spark, small_dir).collect())
    short = {i for i, t in rows if len((t or "").split()) < 1500}
    assert [x for x in got if x[0] in short] == sorted(contract(i, t) for i, t in rows if i in short)
    assert len(got) == len(rows) and any(x[1] for x in got)


def test_edge_rows(spark, edge_docs, no_docs, folder):
    where = folder(documents=edge_docs)
    got = queries.op11_periodic_runs(spark, where)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 6 + ["string"] * 2
    rows = [tuple(x) for x in got.collect()]
    want = [contract(x["doc_id"], x["text"]) for x in edge_docs.collect() if len((x["text"] or "").split()) < 10_000]
    assert len(rows) == edge_docs.count()
    long_ = {9}
    assert sorted((x for x in rows if x[0] not in long_), key=repr) == sorted(want, key=repr)
    assert no_docs.select(runs.periodic_runs(F.col("text")).alias("x")).count() == 0
