import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from veloframe.llm import lexical, queries

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    """(item_id, rank, doc_id, score) from the definition; items in the order given."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n, length = len(held), sum(x for _, _, x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        own, scores = Counter(terms(text)), []
        for i, c, size in held:
            m = 100 - 25 + (25 * size * n) // length
            s = sum(often * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (
                1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t, often in own.items() if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def test_terms():
    for text in ("Ab-cD 9x_\u00c9t\u00e9!", "\x00a\x7fb[c]{d}", "", "\u6c34 \u00df\u00dfA", "@@ 0"):
        assert [t.decode() for t in lexical.terms(text.encode())] == terms(text)


def rows_of(r, n, vocabulary):
    listed = [sorted(r.sample(range(vocabulary), r.randrange(1, 9))) for _ in range(n)]
    listed += listed[:n // 5]
    start = np.concatenate([[0], np.cumsum([len(x) for x in listed])])
    term = np.array([t for x in listed for t in x])
    exact = np.array([r.randrange(1, 900_000) for _ in term], np.int64)
    weight = np.array([r.randrange(0, 9000) for _ in range(vocabulary)], np.int64)
    ids = np.array(r.sample(range(10 * len(listed)), len(listed)))
    return lexical.Sparse(ids, start, term, exact, exact * np.sqrt(weight[term])), weight


@pytest.mark.parametrize("vocabulary", (9, 60, 600))
def test_search_is_exact_and_prunes(vocabulary):
    r = random.Random(vocabulary)
    rows, weight = rows_of(r, 1500, vocabulary)
    tree = lexical.ball_tree(rows, vocabulary)
    seen = []
    for _ in range(30):
        exact = np.zeros(vocabulary, np.int64)
        for t in r.sample(range(vocabulary), 3):
            exact[t] = r.randrange(1, 4)
        scaled = exact * np.sqrt(weight)
        whole = rows.products(rows.exact, exact * weight)
        ids, scores = lexical.best(rows.ids[whole > 0], whole[whole > 0], 20)
        for least in (1, int(scores[-1]) if len(scores) == 20 else 1):
            opened = []
            got = lexical.search(tree, exact * weight, scaled, 20, least, opened.append)
            assert got[0].tolist() == ids.tolist() and got[1].tolist() == scores.tolist()
            seen.append(sum(opened))
    assert vocabulary < 600 or sum(seen) < 0.7 * len(seen) * len(rows)


def test_bounds_hold_for_all_rows_below():
    r = random.Random(4)
    rows, weight = rows_of(r, 700, 40)

    def visit(node):
        below = [node.leaf] if node.leaf else [x for c in node.children for x in visit(c)]
        for _ in range(5):
            q = np.zeros(40)
            q[r.sample(range(40), 4)] = r.randrange(1, 5)
            scaled = q * np.sqrt(weight)
            upper = lexical.upper_bound(node, scaled)
            assert all((x.products(x.exact.astype(float), q * weight) <= upper).all() for x in below)
        return below

    assert sum(len(x) for x in visit(lexical.ball_tree(rows, 40))) == len(rows)


def test_small_table(spark, small_dir, monkeypatch):
    docs = [(x["doc_id"], x["text"]) for x in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    items = [(x["item_id"], x["text"]) for x in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    want = brute(docs, items)
    got = queries.op12_lexical_search(spark, small_dir)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint"]
    assert sorted((tuple(x) for x in got.collect()), key=repr) == want
    # many shards, two rounds, several blocks of items
    monkeypatch.setattr(lexical, "SHARD_ENTRIES", 400)
    monkeypatch.setattr(lexical, "LEAF_ROWS", 4)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 4000)
    assert len(list(lexical.item_blocks(spark.read.parquet(f"{small_dir}/benchmark.parquet")))) > 1
    got = queries.op12_lexical_search(spark, small_dir)
    assert sorted((tuple(x) for x in got.collect()), key=repr) == want


def test_edge_rows(spark, edge_docs, no_docs):
    items = [(1, "one TWO three"), (1, "one TWO three"), (2, None), (3, ""), (4, "?!"), (None, "\u00e9 \u00df end"),
             (5, "nowhere_else"), (6, "w1 w2 w2 w3 " * 500)]
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "text", "1 AS at", "2 AS block")
    docs = [(x["doc_id"], x["text"]) for x in edge_docs.collect()]
    got = [tuple(x) for x in lexical.lexical_top_k(edge_docs, table).collect()]
    assert sorted(got, key=repr) == brute(docs, items)
    assert lexical.lexical_top_k(no_docs, table).count() == 0
    assert lexical.lexical_top_k(edge_docs, table.limit(0)).count() == 0
