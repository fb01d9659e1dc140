import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from veloframe.llm import packing as K
from veloframe.llm.queries import op7_best_fit_packing

DEFINING = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(text):
    return [*DEFINING.encode(text, add_special_tokens=False).ids, 2]


def test_quick_encoder_gives_the_defining_ids():
    r = random.Random(0)
    alphabet = list("abz AZ09 \n\t\r\x0b\x0c'sll.,!?-_ éßñ漢字😀  ́ªºǅ٣Ⅷ\x00\x1c") + ["'re", "  ", "\n\n", "<|endoftext|>"]
    for _ in range(3000):
        text = "".join(r.choices(alphabet, k=r.randint(0, 40)))
        assert K.encode(text, "byte_bpe_50k") == DEFINING.encode(text, add_special_tokens=False).ids, repr(text)


def places(runs, counts, capacity):
    bins, used = defaultdict(list), Counter()
    for length, first, n, sequence, offset in runs:
        assert first == used[length]
        used[length] += n
        for k in range(n):
            bins[sequence + k].append((offset, length))
    assert used == Counter({k: v for k, v in counts.items() if v})
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


def optimum(items, capacity):
    best = len(items)

    def search(k, room):
        nonlocal best
        if len(room) >= best:
            return
        if k == len(items):
            best = len(room)
            return
        for i in {r: i for i, r in enumerate(room) if r >= items[k]}.values():
            room[i] -= items[k]
            search(k + 1, room)
            room[i] += items[k]
        search(k + 1, [*room, capacity - items[k]])

    search(0, [])
    return best


def test_packing_is_valid_and_close_to_the_bound():
    r = random.Random(1)
    for _ in range(200):
        capacity = r.choice((7, 20, 64))
        counts = Counter(r.randint(1, capacity) for _ in range(r.randint(0, 300)))
        runs, n = K.reduce_and_fit(counts, capacity)
        bins = places(runs, counts, capacity)
        assert len(bins) == n and set(bins) == set(range(n))
        assert n <= 11 / 9 * -(-sum(k * v for k, v in counts.items()) // capacity) * 1.5 + 1


def test_small_instances_are_close_to_the_optimum():
    r = random.Random(2)
    worse = 0
    for _ in range(120):
        items = sorted((r.randint(2, 20) for _ in range(9)), reverse=True)
        _, n = K.reduce_and_fit(Counter(items), 20)
        worse += n - optimum(items, 20)
    assert worse <= 8


def check(rows, docs):
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(list)
    for i, t in docs:
        own = ids(t or "")
        first = (len(own) - 1) % 1024 + 1
        starts = [0, *range(first, len(own), 1024)]
        for k, s in enumerate(starts):
            part = own[s:first if not k else s + 1024]
            want[i].append((k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert {i: sorted(p) for i, p in pieces.items()} == {i: sorted(p) for i, p in want.items()}
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024


def test_query_on_edge_rows(spark, edge_docs, folder):
    check(op7_best_fit_packing(spark, folder(documents=edge_docs)).collect(),
          [(r["doc_id"], r["text"]) for r in edge_docs.collect()])


def test_query_on_documents(spark, small_dir):
    rows = op7_best_fit_packing(spark, small_dir).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()])
    bound = -(-sum(r["length"] for r in rows) // 1024)
    assert len({r["sequence_id"] for r in rows}) <= 1.03 * bound + 1


def test_empty_table(spark, no_docs, folder):
    assert op7_best_fit_packing(spark, folder(documents=no_docs)).count() == 0


@pytest.mark.parametrize("text", ["", " " * 5000, "a" * 20000, "<|endoftext|>x"])
def test_odd_texts(text):
    assert [*K.encode(text, "byte_bpe_50k"), 2] == ids(text)
