import pathlib
import random
from collections import Counter

import numpy as np
import pytest

from veloframe.llm import jaccard_join as J
from veloframe.llm.components import connected_components
from veloframe.llm.queries import op10_jaccard_join
from veloframe.sources.catalog import shared_path

from .conftest import SCHEMA, document, sentence


def sets_of(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(zip(w, w[1:], w[2:], strict=False)) if len(w) > 2 else frozenset([tuple(w)])


def brute(docs, percent=90):
    """(doc_id, n_shingles, component_id) by all pairs; rows of one id belong together."""
    rows = [(i, sets_of(t)) for i, t in docs]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, (i, s) in enumerate(rows):
        for y in range(x):
            t = rows[y][1]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                up[root(x)] = root(y)
    least = {}
    for x, (i, s) in enumerate(rows):
        if s and i is not None:
            least[root(x)] = min(i, least.get(root(x), i))
    return Counter((i, len(s), least.get(root(x)) if s else i) for x, (i, s) in enumerate(rows))


def result(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def copies(n=40, seed=0):
    """Groups of exact and near copies around the threshold, and a line that many share."""
    r = random.Random(seed)
    line, rows = sentence(r, 25, 300), []
    for g in range(n):
        base = sentence(r, r.randint(3, 200), 5000).split()
        for _ in range(r.randint(1, 6)):
            words = base[:]
            for _ in range(r.choice((0, 0, 1, 2, 4))):
                words[r.randrange(len(words))] = f"x{r.randrange(9999)}"
            rows.append(" ".join(words) + (" " + line if g % 3 == 0 else ""))
    r.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def test_t_occurrence_equals_all_pairs():
    r = random.Random(3)
    for _ in range(60):
        base = r.sample(range(10 ** 6), 40)
        sets = [np.unique(np.array(r.sample(base, r.randint(30, 40)) + r.sample(range(10 ** 6, 10 ** 7), r.randint(0, 3)),
                                   np.uint64)) for _ in range(r.randint(1, 14))]
        for marked in (np.ones(len(sets), bool), np.array([r.random() < 0.5 for _ in sets])):
            forest, want = J.Forest(len(sets)), J.Forest(len(sets))
            for x, y in J.t_occurrence(sets, marked):
                o = len(np.intersect1d(sets[x], sets[y]))
                assert 100 * o >= 90 * (len(sets[x]) + len(sets[y]) - o)
                forest.join(x, y)
            for x in range(len(sets)):
                for y in range(x):
                    o = len(np.intersect1d(sets[x], sets[y]))
                    if 100 * o >= 90 * (len(sets[x]) + len(sets[y]) - o) and (marked.all() or marked[x] != marked[y]):
                        want.join(x, y)
            assert [forest.root(x) for x in range(len(sets))] == [want.root(x) for x in range(len(sets))]


def test_query_on_edge_rows(spark, edge_docs, folder):
    want = brute([(r["doc_id"], r["text"]) for r in edge_docs.collect()])
    assert result(op10_jaccard_join(spark, folder(documents=edge_docs))) == want


@pytest.mark.parametrize("chunk", [J.CHUNK, 300])
def test_near_copies_and_small_chunks(spark, chunk):
    rows = copies()
    docs = spark.createDataFrame([document(i, t) for i, t in rows], SCHEMA).repartition(3)
    assert result(J.jaccard_components(docs, chunk=chunk)) == brute(rows)


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_sampled_sets_find_what_whole_sets_find(spark, width, percent):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sampled = result(J.jaccard_components(docs, percent, width=width))
    assert sampled == result(J.jaccard_components(docs, percent, width=width, rates=J.EXACT))
    assert len({c for _, _, c in sampled}) < docs.count()


def test_scratch_goes_as_it_is_read(spark, edge_docs):
    folder = pathlib.Path(shared_path(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    J.jaccard_components(edge_docs.select("doc_id", "text"))
    assert {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before} == {"join-found"}


def test_one_of_each(spark, edge_docs):
    kept = J.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[0] == 1 and 1 not in ids and 2 not in ids  # 0 stands for its copies
    assert ids[3] == ids[4] == ids[5] == 1 and ids[8] == 0 and ids[7] == 1
    assert ids[None] == 2  # the null text and the row of its own


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100 + r.randrange(30), 100 + r.randrange(30)) for _ in range(25)]
    up = {}

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: root(x) for x in nodes}


def test_empty_table(spark, no_docs, folder):
    assert op10_jaccard_join(spark, folder(documents=no_docs)).count() == 0
    assert J.one_of_each(no_docs).count() == 0
