import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from veloframe.llm import mixing as M
from veloframe.llm.queries import op6_source_mixing

from .conftest import SCHEMA, document, sentence


def test_targets_stop_at_twice_the_source():
    sizes = [100, 1000, 1000, 10, 0, 500]
    targets = M.source_targets(sizes)
    assert sum(targets) == pytest.approx(1.5 * sum(sizes))
    assert all(t <= 2 * s + 1e-9 for t, s in zip(targets, sizes, strict=True))
    w = [3, 1, 2, 3, 1, 2]
    free = [t / x for t, x, s in zip(targets, w, sizes, strict=True) if t < 2 * s]
    assert max(free) == pytest.approx(min(free))


def test_permutation_is_one():
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        for key in (1, 99):
            image = M.shuffled(np.arange(n), np.full(n, n), np.full(n, key))
            assert sorted(image.tolist()) == list(range(n))
    assert M.shuffled(np.arange(100), np.full(100, 100), np.full(100, 1)).tolist() != list(range(100))


def test_shard_counts_add_up():
    due = np.array([1000, 0, 37, 5])
    counts = M.shard_counts(due, 16, 1)
    assert counts.sum(axis=0).tolist() == due.tolist() and (counts >= 0).all()


def check(rows, docs):
    size = Counter()
    for _, t, s in docs:
        size[s] += len((t or "").encode().split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, M.source_targets([size[s] for s in order]), strict=True))
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((i, len((t or "").encode().split()))
                                                                      for i, t, _ in docs)
    taken = Counter()
    for r in rows:
        assert r["taken"] <= 2 * r["size"] and r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        taken[r["source"]] += r["taken"]
    for s in order:
        assert abs(taken[s] - targets[s]) <= M.BLOCK_WORDS


def test_query_on_edge_rows(spark, edge_docs, folder):
    check(op6_source_mixing(spark, folder(documents=edge_docs)).collect(),
          [(r["doc_id"], r["text"], r["source"]) for r in edge_docs.collect()])


def signed(x):
    return x - 2 ** 64 * (x >= 2 ** 63)


def chained(*values):
    """Spark's xxhash64 of (bytes of) columns; nulls are passed over."""
    h = 42
    for v in values:
        h = h if v is None else xxhash.xxh64_intdigest(v, h)
    return signed(h)


def image(index, domain, key, rounds=4):
    """The permutation for one index, in plain integers."""
    half = 1
    while 4 ** half < domain:
        half += 1
    mask, all_ = 2 ** half - 1, 2 ** 64 - 1
    while True:
        left, right = index >> half, index & mask
        for k in range(1, rounds + 1):
            f = (right + key + k * 0x9E3779B97F4A7C15) & all_
            f = (f ^ f >> 30) * 0xBF58476D1CE4E5B9 & all_
            f = (f ^ f >> 27) * 0x94D049BB133111EB & all_
            left, right = right, left ^ (f ^ f >> 31) & mask
        index = left << half | right
        if index < domain:
            return index


def taken_by_brute(docs, seed=17, n=64):
    """Words that the mix takes, by (doc_id, text, source): words laid end to end, passes and blocks counted off."""
    streams, same = {}, Counter()
    for i, t, s in sorted(docs, key=lambda x: (x[2] is None, x[2] or "")):
        tie = chained(None if t is None else t.encode())
        same[i, tie] += 1
        long_ = [v if v is None else v.to_bytes(8, "little", signed=True) for v in (i, tie)]
        part = chained(*long_, same[i, tie].to_bytes(4, "little")) % 4
        streams.setdefault(s, []).append((part, i is not None, i or 0, tie, same[i, tie], (i, t, s)))
    order = list(streams)
    words = {s: [d for *_, d in sorted(streams[s], key=lambda x: x[:5]) for _ in (d[1] or "").encode().split()] for s in order}
    targets, out = M.source_targets([len(words[s]) for s in order]), Counter()
    for k, s in enumerate(order):
        blocks = [words[s][a:a + n] for a in range(0, len(words[s]), n)]
        if not blocks:
            continue
        passes = int(targets[k] // len(words[s]))
        for epoch in range(passes + 1):
            key = (k + 1) * 0x100000001B3 + epoch * 0x10001 + seed
            listed = [blocks[image(b, len(blocks) - 1, key)] for b in range(len(blocks) - 1)] + [blocks[-1]]
            if epoch == passes:  # a part pass: as many whole blocks as come nearest to what is left, or all
                left, full = targets[k] - passes * len(words[s]), (len(blocks) - 1) * n
                if left <= (full + len(words[s])) / 2:
                    listed = listed[:min(len(blocks) - 1, round(left / n))]
            for block in listed:
                out.update(block)
    return out


def test_query_equals_brute_force(spark, edge_docs, folder):
    r = random.Random(4)
    rows = [document(i, sentence(r, r.randint(0, 300)), "hot" if i % 3 else f"s{i % 5}") for i in range(300)]
    hot = spark.createDataFrame(rows + rows[:20], SCHEMA).repartition(4)
    for name, table in (("edge", edge_docs), ("hot", hot)):
        docs = [(x["doc_id"], x["text"], x["source"]) for x in table.select("doc_id", "text", "source").collect()]
        text = {(i, chained(None if t is None else t.encode())): t for i, t, _ in docs}
        got = Counter()
        mixed, taken = M.mix(table)
        of = {(x["doc_id"], x["tie"], x["copy"]): x["source"] for x in mixed.collect()}
        for x in taken.collect():
            got[x["doc_id"], text[x["doc_id"], x["tie"]], of[x["doc_id"], x["tie"], x["copy"]]] += x["words"]
        want = taken_by_brute(docs)
        assert got == want
        table.write.parquet(f"{folder()}/{name}/documents.parquet")
        asked = Counter()
        for x in op6_source_mixing(spark, f"{folder()}/{name}").collect():
            asked[x["doc_id"], x["source"]] += x["taken"]
        by_source = Counter()
        for (i, _, s), w in want.items():
            by_source[i, s] += w
        assert +asked == +by_source


def test_query_agrees_with_itself_and_hot_source(spark, folder):
    r = random.Random(2)
    rows = [document(i, sentence(r, r.randint(0, 300)), "hot" if i % 3 else f"s{i % 5}") for i in range(300)]
    path = folder(documents=spark.createDataFrame(rows, SCHEMA).repartition(4))
    first = op6_source_mixing(spark, path).collect()
    check(first, [(x[0], x[1], x[3]) for x in rows])
    assert {(r["doc_id"], r["taken"]) for r in first} == {
        (r["doc_id"], r["taken"]) for r in op6_source_mixing(spark, path).collect()}


def test_mixed_texts_hold_the_words_taken(spark, edge_docs):
    _, taken = M.mix(edge_docs)
    out = M.mixed(edge_docs)
    assert out.columns == edge_docs.columns
    rows = out.collect()
    assert sum(len(r["text"].encode().split()) for r in rows) == sum(r["words"] for r in taken.collect())
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_many_sources_are_joined_without_a_broadcast(spark):
    r = random.Random(9)
    rows = [document(i, sentence(r, r.randint(0, 90)), "hot" if i % 3 else f"s{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = [[Counter(map(tuple, part.collect())) for part in M.mix(docs, max_broadcast_bytes=b)]
             for b in (0, M.BROADCAST_BYTES)]
    assert found[0] == found[1]
    key = ["doc_id", "source", "text"]
    texts = [Counter(map(tuple, M.mixed(docs, max_broadcast_bytes=b).select(*key).collect())) for b in (0, M.BROADCAST_BYTES)]
    assert texts[0] == texts[1] and len(texts[0]) > 50


def test_empty_table(spark, no_docs, folder):
    assert op6_source_mixing(spark, folder(documents=no_docs)).count() == 0
    assert M.mixed(no_docs).count() == 0


def test_blocks_stand_in_drawn_shards_and_slots(spark, folder):
    r = random.Random(6)
    rows = [document(i, sentence(r, r.randint(0, 300)), "abc"[i % 3]) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = M.mixed_blocks(docs).collect()
    sizes = Counter()
    for _, t, _, s, *_ in rows:
        sizes[s] += len(t.split())
    order = [sizes[s] for s in "abc"]
    n_blocks, due = M.draws(order, M.source_targets(order), M.BLOCK_WORDS)
    counts = M.shard_counts(due, M.OUTPUT_SHARDS, 17)
    got = Counter((x["out_shard"], x["source"]) for x in out)
    assert got == Counter({(i, s): int(n) for i, line in enumerate(counts) for s, n in zip("abc", line) if n})
    slots = {}
    for x in out:
        slots.setdefault(x["out_shard"], []).append(x["slot"])
        assert x["words"] == len(x["text"].split()) <= M.BLOCK_WORDS
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = {}
    for x in out:  # a block holds the same words in every pass, and all blocks of a pass are the source
        assert texts.setdefault((x["source"], x["block"]), x["text"].split()) == x["text"].split()
    for k, s in enumerate("abc"):
        if due[k] >= n_blocks[k]:
            words = Counter(w for (of, _), t in texts.items() if of == s for w in t)
            assert words == Counter(w for x in rows if x[3] == s for w in x[1].split())
    assert max(due // n_blocks) >= 1
    where = {}
    for x in M.mix(docs)[1].collect():
        where.setdefault(x["doc_id"], set()).add(x["out_shard"])
    path = folder(documents=docs)
    assert {x["doc_id"]: x["out_shards"] for x in op6_source_mixing(spark, path).collect()} == {
        i: ",".join(map(str, sorted(where.get(i, ())))) for i in range(300)}


def test_blocks_of_edge_rows_and_empty_table(spark, edge_docs, no_docs):
    out = M.mixed_blocks(edge_docs).collect()
    assert sum(x["words"] for x in out) == sum(x["words"] for x in M.mix(edge_docs)[1].collect())
    assert all(x["words"] == len(x["text"].encode().split()) for x in out)
    assert M.mixed_blocks(no_docs).count() == 0


def test_rows_that_differ_in_source_only(spark):
    r = random.Random(8)
    rows = []
    for i in range(60):  # by falling source, null first
        text = sentence(r, r.randint(1, 150))
        rows += [document(i, text, s) for s in (None, "c", "b", "a")[i % 2:]]
    rows += [document(100 + i, sentence(r, 200), "a") for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    sources, taken = M.mix(docs)
    of = {(x["doc_id"], x["tie"], x["copy"]): x["source"] for x in sources.collect()}
    want = Counter()
    for x in taken.collect():
        want[x["doc_id"], of[x["doc_id"], x["tie"], x["copy"]]] += x["words"]
    for out in (M.mixed(docs), M.mixed(docs.repartition(5))):
        got = Counter()
        for x in out.collect():
            got[x["doc_id"], x["source"]] += len(x["text"].split())
        assert got == want
    got, want = Counter(), Counter()
    for x in M.mixed_blocks(docs).collect():
        got[x["out_shard"], x["slot"], x["source"]] += x["words"]
    for x in taken.collect():
        want[x["out_shard"], x["slot"], of[x["doc_id"], x["tie"], x["copy"]]] += x["words"]
    assert got == want
