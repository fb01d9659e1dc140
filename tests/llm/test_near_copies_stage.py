import random
from itertools import combinations

import corpus_pipeline as P

from .conftest import SCHEMA, document, sentence
from .test_jaccard_join import copies


def kept_by_brute(rows, width=5, percent=80):
    """The least doc_id of each group that links connect, by all pairs; ids are unique."""
    def shingles(text):
        w = text.lower().split()
        return {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()

    sets, up = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        s, t = sets[a], sets[b]
        if s and 100 * len(s & t) >= percent * len(s | t):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i for i in sets if root(i) == i}


def test_near_copies_of_five_words_and_four_fifths(spark):
    r = random.Random(5)
    words = [f"u{k}" for k in range(200)]
    rows = [(0, " ".join(words)), (1, " ".join(f"e{k}" if k in (30, 70, 110, 150) else w for k, w in enumerate(words))),
            (2, "one two three"), (3, "One two three"), (4, "one two four"), (5, "")]
    rows += [(10 + i, t) for i, t in copies(40, seed=4)]
    for g in range(12):  # larger sets around the threshold, which are sampled at every rate
        base = sentence(r, r.choice((90, 150, 300, 700)), 5000).split()
        for k in range(4):
            own = base[:]
            for at in r.sample(range(len(own)), round(len(own) * r.choice((0.01, 0.018, 0.023, 0.03)))):
                own[at] = f"y{r.randrange(9999)}"
            rows.append((1000 + 10 * g + k, " ".join(own)))
    docs = spark.createDataFrame([document(i, t) for i, t in rows], SCHEMA).repartition(3)
    got = [x["doc_id"] for x in P.drop_near_copies(spark, docs, "").collect()]
    want = kept_by_brute(rows)
    assert 0 in want and 1 not in want and want != kept_by_brute(rows, 3, 90)
    assert sorted(got) == sorted(want)


def test_near_copies_of_the_small_table(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    got = [x["doc_id"] for x in P.drop_near_copies(spark, docs, small_dir).collect()]
    assert sorted(got) == sorted(kept_by_brute([(x["doc_id"], x["text"]) for x in docs.collect()]))
