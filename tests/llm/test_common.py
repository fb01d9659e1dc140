from collections import defaultdict

from pyspark.sql import functions as F

from veloframe.llm import common as C


def test_running_start_equals_a_plain_running_sum(spark, monkeypatch):
    monkeypatch.setattr(C, "GROUP_ROWS", 100)
    rows = [(0 if i % 3 else i % 5, i, i % 7) for i in range(1500)]  # key 0 holds two thirds
    df = spark.createDataFrame(rows, "k int, i long, size long")
    out = C.running_start(df, ["k"], ["i"], F.col("size"), len(rows), "start").collect()
    spans = defaultdict(list)
    for r in out:
        spans[r.k].append((r.start, r.start + r.size))
    for own in spans.values():
        at = 0
        for start, end in sorted(own):
            assert start == at
            at = end
    assert len(out) == len(rows)


def test_word_count_cuts_at_ascii_blanks_only(spark):
    texts = [None, "", " \t\n\x0b\f\r", "a b", "a\x1cb c", "é ß", "a\u00a0b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.n for r in df.select("i", C.word_count(F.col("t")).alias("n")).orderBy("i").collect()]
    assert got == [0, 0, 0, 2, 2, 2, 1]


def test_with_copy_numbers_equal_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (None, None), (1, "b")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text or "", r["__copy"]) for r in C.with_copy(df).collect())
    assert got == [(0, "", 1), (0, "", 2), (1, "a", 1), (1, "a", 2), (1, "b", 1)]


def test_slices_keep_rows_and_order(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(C, "SLICE_ROWS", 3)
    column = pa.array([str(i) if i % 4 else None for i in range(11)])
    assert list(C.texts(column)) == [str(i).encode() if i % 4 else b"" for i in range(11)]
    assert C.sliced(lambda c: pa.array([x and x * 2 for x in c.to_pylist()], pa.string()), pa.string(), column).to_pylist() \
        == [str(i) * 2 if i % 4 else None for i in range(11)]
    assert len(C.sliced(lambda c: c, pa.string(), pa.array([], pa.string()))) == 0
