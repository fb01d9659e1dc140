import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, tie string, n int, "
          "node long, shard string, size string, found string, copies int, copy int, __copy int, words string")


def document(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None if text is None else len(text), 0.5, "t", 1, 2, "s", "z", "f", 3, 4, 5, "w")


def sentence(r, n, vocabulary=2000):
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def edge_rows():
    """Nulls, empty, blank, short, very long, tied, repeated and nearly equal rows."""
    r = random.Random(3)
    base, shared = sentence(r, 120), sentence(r, 60)
    long_ = sentence(r, 40_000, 10 ** 6)
    words = base.split()
    near = " ".join([*words[:119], "other"])
    rows = [(0, base), (1, base), (1, base), (2, near), (3, None), (4, ""), (5, " \t\n\v\f\r "), (6, "one"),
            (7, "one two"), (8, "ONE two"), (9, long_), (10, sentence(r, 30) + "\n" + shared + " end"),
            (11, shared + "\t" + sentence(r, 45)), (None, base), (None, None), (None, "a null id of its own"),
            (12, sentence(r, 200)), (12, sentence(r, 200)), (13, "é ß 😀 " * 40), (14, "é ß 😀 " * 40),
            (15, sentence(r, 49)), (16, sentence(r, 50)), (17, " ".join(words[:50])), (18, "\x1c x y")]
    return [document(i, t, None if k % 7 == 6 else "abc"[k % 3]) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def edge_docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def folder(spark, tmp_path):
    """Writes tables as an input folder."""
    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write
