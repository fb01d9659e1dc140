import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from veloframe.llm import fingerprints as P
from veloframe.llm.queries import op5_simhash_fingerprints

from .conftest import sentence


def edited(texts):
    out = []
    for k, t in enumerate(texts):
        n = len(t) // 3
        out.append(t[:len(t) - n] + texts[(k + 1) % len(texts)][:n])
    return out


def brute_fingerprint(spark, text):
    words = [w for w in text.replace("\v", " ").split(" ") if w] if text.strip() else []
    rows = spark.createDataFrame([(w,) for w in words], "w string").select(
        F.xxhash64("w").alias("h"), F.char_length("w").alias("n")).collect() if words else []
    votes = [0] * 64
    for h, n in rows:
        for b in range(64):
            votes[b] += min(n * n, 63) * (1 if h >> b & 1 else -1)
    return f"{sum(1 << b for b in range(64) if votes[b] > 0):016x}"


def test_query_on_edge_rows(spark, edge_docs, folder):
    rows = op5_simhash_fingerprints(spark, folder(documents=edge_docs)).collect()
    docs = [(r["doc_id"], r["text"] or "") for r in edge_docs.collect()]
    ids = sorted((i for i, _ in docs if i is not None), reverse=True)
    assert Counter((r["doc_id"], r["n_chars"]) for r in rows) == Counter((i, len(t)) for i, t in docs)
    # where ids are unique around a row, its edited text is known
    by_id = {i: t for i, t in docs if i is not None}
    count, order = Counter(ids), sorted(set(ids), reverse=True)
    known = {r["doc_id"]: r for r in rows}
    for a, b in zip(order, order[1:], strict=False):
        if count[a] == count[b] == 1:
            assert known[a]["edited_sha256"] == hashlib.sha256(edited([by_id[a], by_id[b]])[0].encode()).hexdigest()
    prints = {}
    for r in rows:
        if r["doc_id"] is not None and count[r["doc_id"]] == 1:
            assert prints.setdefault(by_id[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert known[4]["fingerprint"] == "0" * 16


def test_votes_equal_brute_force_on_very_long_texts(spark):
    r = random.Random(0)
    texts = ["", "one", sentence(r, 700), " x\ty\nz " + "longer word " * 3000]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {t: f for t, f in docs.select("text", P.as_hex(P.fingerprint(F.col("text")))).collect()}
    assert got["one"] == brute_fingerprint(spark, "one")
    assert got[texts[2]] == brute_fingerprint(spark, texts[2])
    assert got[texts[3]] == brute_fingerprint(spark, texts[3].replace("\t", " ").replace("\n", " "))


def test_grouped_votes_equal_those_of_one_text(spark):
    r = random.Random(6)
    texts = ["", " ", "\x0b", "one", "a  b\tc ", "\u00e9 \u00df\U0001f600", sentence(r, 511), sentence(r, 512), sentence(r, 513),
             "longer word " * 3000]
    docs = spark.createDataFrame([(k, t, texts[-1 - k]) for k, t in enumerate(texts)], "id long, text string, other string")
    want = docs.select("id", P.fingerprint(F.col("text")).alias("x"), P.fingerprint(F.col("other")).alias("y"))
    got = P.voted(docs, {"text": "x", "other": "y"})
    assert sorted(map(tuple, got.select("id", "x", "y").collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SortAggregate" not in plan


def test_near_counts_equal_brute_force(spark):
    r = random.Random(4)
    prints = [r.getrandbits(64) for _ in range(60)]
    for p in prints[:30]:
        q = p
        for b in r.sample(range(64), r.randint(1, 5)):
            q ^= 1 << b
        prints.append(q)
    signed = [p - 2 ** 64 if p >> 63 else p for p in set(prints)]
    got = dict(P.near_counts(spark.createDataFrame([(p,) for p in signed], "fingerprint long")).collect())
    want = {p: sum((p ^ q) & (2 ** 64 - 1) and ((p ^ q) & (2 ** 64 - 1)).bit_count() <= 3 and 1 or 0 for q in signed)
            for p in signed}
    assert got == {p: n for p, n in want.items() if n}


def test_single_row_follows_itself_and_empty_table(spark, no_docs, folder, tmp_path):
    one = spark.createDataFrame([(1, "abcdefghi")], "doc_id long, text string")
    row = op5_simhash_fingerprints(spark, folder(documents=one)).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdefabc").hexdigest() and row["near_next"] == 1.0
    assert P.fingerprints(no_docs).count() == 0


def test_main_path_has_no_python(edge_docs):
    plan = P.edited(edge_docs).select(P.fingerprint(F.col("edited")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
