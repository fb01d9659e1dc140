import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veloframe.llm import quality, queries


def plain_features(text):
    """Buckets of a text's features, one by one."""
    words = text.split()

    def value(raw):
        h = 0
        for x in raw:
            h = (h * int(quality._MULTIPLIER) + x) % 2 ** 64
        return h

    def ascending(raw):  # the word hash has its powers the other way round
        return sum(x * pow(int(quality._MULTIPLIER), k, 2 ** 64) for k, x in enumerate(raw)) % 2 ** 64

    def put(h, salt):
        return int(quality.bucket(np.array([h], np.uint64), salt)[0])

    out = [put(ascending(w), 1) for w in words]
    for a, b in zip(words, words[1:]):
        out.append(put((ascending(a) * 31 % 2 ** 64) ^ ascending(b), 2))
        if a == b:
            out.append(quality.AGAIN)
    line = b" " + b" ".join(words) + b" "
    for n in quality.GRAMS:
        for k in range(len(line) - n + 1):
            if words and b" " not in line[k + 1:k + n - 1]:
                out.append(put(value(line[k:k + n]), 10 + n))
    return sorted(out)


def test_features_one_by_one():
    batch = [b"the the cat", b"", " \xe9\u00df \u6c34 x ".encode(), b"a", b"\n \t", b"cat! cat! cat! dog"]
    found = [[] for _ in batch]
    for owner, b in quality.features(batch):
        for k, x in zip(owner.tolist(), b.tolist(), strict=True):
            found[k].append(x)
    assert [sorted(x) for x in found] == [plain_features(x) for x in batch]


def test_scores_from_vectors_and_layer():
    """A score equals the softmax over the mean vector, whatever the batch."""
    r = random.Random(1)
    documents = [" ".join(f"w{r.randrange(50)}" for _ in range(r.randrange(0, 60))).encode() for _ in range(40)]
    model = quality.fit(documents, [k % 2 for k in range(40)], steps=200)
    got = model.scorer().scores(documents)
    for x, p in zip(documents, got.tolist(), strict=True):
        found = plain_features(x)
        mean = model.vectors[found].astype(float).mean(axis=0) if found else np.zeros(quality.SIZE)
        z = model.layer @ mean + model.bias
        assert p == pytest.approx(np.exp(z[1]) / np.exp(z).sum(), abs=1e-5)
    assert [model.scorer().scores([x])[0] for x in documents] == got.tolist()


def test_one_label_or_none():
    for rows in ([], [b"a b", b"c"]):
        model = quality.fit(rows, [1] * len(rows))
        assert model.scorer().scores([b"a b", b"", b"zz"]).tolist() == [0.5] * 3


def test_portions_keep_rows():
    column = pa.array(["a" * 700_000, None, "b", "c" * 800_000, ""])
    assert [len(x) for x in quality.portions(column)] == [4, 1]


def test_held_out_accuracy(spark, small_dir):
    where = small_dir.replace("sf0.001", "sf0.01")
    rows = {x["doc_id"]: x for x in queries.op13_quality_classifier(spark, where).collect()}
    docs = {x["doc_id"]: x["text"] for x in spark.read.parquet(f"{where}/documents.parquet").collect()}
    assert rows.keys() == docs.keys()
    by_text, seen = {}, []
    for i, row in rows.items():
        assert row["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= row["score"] <= 1
        assert row["predicted"] == (row["score"] >= 0.3)
        assert by_text.setdefault(docs[i], row["score"]) == row["score"]
    for x in spark.read.parquet(f"{where}/labels.parquet").collect():
        if x["doc_id"] in rows and rows[x["doc_id"]]["held_out"]:
            seen.append((x["quality"], rows[x["doc_id"]]["predicted"]))
    good = [p for q, p in seen if q == 1]
    poor = [p for q, p in seen if q == 0]
    assert sum(good) / len(good) > 0.97 and sum(poor) / len(poor) < 0.2


def test_held_out_labels_are_not_learned(spark, edge_docs):
    ids = [x["doc_id"] for x in edge_docs.select("doc_id").distinct().collect()]
    labels = spark.createDataFrame([(i, (i or 0) % 2, 0) for i in ids] + [(1, 0, 0), (2, None, 1), (3, 7, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.sampled(edge_docs, labels)
    texts = {}
    for x in edge_docs.collect():
        texts.setdefault(x["text"], set()).add(x["doc_id"])
    for text, _ in rows:
        assert any(i is not None and zlib.crc32(str(i).encode()) % 5 for i in texts[text.decode()])
    assert len(quality.sampled(edge_docs, labels, per_label=2)) == 4
    assert all(len(t) <= 100 for t, _ in quality.sampled(edge_docs, labels, most=100))


def test_edge_rows(spark, edge_docs, no_docs, folder):
    labels = spark.createDataFrame([(0, 1, 0), (2, 0, 0), (12, 1, 0)], "doc_id long, quality int, toxic int")
    got = queries.op13_quality_classifier(spark, folder(documents=edge_docs, labels=labels))
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "boolean", "double", "int"]
    rows = got.collect()
    assert len(rows) == edge_docs.count() and all(0 <= x["score"] <= 1 for x in rows)
    model = quality.train(no_docs, labels)
    assert no_docs.select(quality.quality(F.col("text"), model)).count() == 0
