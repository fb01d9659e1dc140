"""Safe casts: the edge table, and a brute-force comparison with Python itself."""

import datetime
import math
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veloframe.functions import casts


def _py_int(s):
    if "_" in s:  # the original scripts ran on Python 2, which has no digit separators
        return None
    try:
        v = int(s)
    except ValueError:
        return None
    return v if -(2 ** 31) <= v < 2 ** 31 else None


def _py_float32(s):
    if "_" in s:
        return None
    try:
        v = float(s)
    except ValueError:
        return None
    if math.isnan(v) or math.isinf(v):
        return v
    try:
        return struct.unpack("f", struct.pack("f", v))[0]
    except OverflowError:
        return math.copysign(math.inf, v)


def _py_strptime(s, fmt):
    try:
        return datetime.datetime.strptime(s, fmt)
    except ValueError:
        return None


def _eval(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", fn(F.col("t")).alias("v")).collect()
    return [r["v"] for r in sorted(rows, key=lambda r: r["i"])]


def _same_float(a, b):
    if a is None or b is None:
        return a is None and b is None
    if math.isnan(a) or math.isnan(b):
        return math.isnan(a) and math.isnan(b)
    return a == b


INT_OK = {"12": 12, " 12 ": 12, "+5": 5, "-3": -3}
INT_NULL = ["12.0", "1e3", "abc", "", "T", "0x1F", "1_000", "99999999999"]
FLOAT_OK = ["1.5", "nan", "inf", "-inf", "Infinity", "1e3", " 2.5 ", ".5", "5.", "+.5e+2"]
FLOAT_NULL = ["1.0f", "1.0d", "0x1p3", "1_0", ".", "-", "1e", "3 4", "infinit", ""]
DATE_OK = {"8/31/2014": datetime.date(2014, 8, 31), "08/05/2014": datetime.date(2014, 8, 5)}
DATE_NULL = ["2/30/2014", "8/31/14", " 8/31/2014", "8/31/2014 ", "8/31/2014 1:00", "8/031/2014", ""]
TS_OK = {
    "8/31/2014 22:31": datetime.datetime(2014, 8, 31, 22, 31),
    "08/31/2014 2:05": datetime.datetime(2014, 8, 31, 2, 5),
    "8/31/2014  1:00": datetime.datetime(2014, 8, 31, 1, 0),
    "8/31/2014 1:5": datetime.datetime(2014, 8, 31, 1, 5),
    "2/29/2012 0:0": datetime.datetime(2012, 2, 29, 0, 0),
}
TS_NULL = ["13/1/2014 1:00", "8/31/2014 24:00", "8/31/2014 1:60", "2/29/2013 0:0", " 8/31/2014 1:00",
           "8/31/2014 1:00 ", "8/31/2014 001:00", "8/31/2014"]
FRAC_OK = {
    "2014-08-31 22:31:05.1": datetime.datetime(2014, 8, 31, 22, 31, 5, 100000),
    "2014-08-31 22:31:05.123456": datetime.datetime(2014, 8, 31, 22, 31, 5, 123456),
    "2014-8-3 2:1:5.12": datetime.datetime(2014, 8, 3, 2, 1, 5, 120000),
}
FRAC_NULL = ["2014-08-31 22:31:05", "2014-08-31 22:31:05.1234567", "2014-08-31 22:31:05.",
             "2014-02-30 01:01:01.5", "2014-08-31 22:31:60.5"]


def test_int_edges(spark):
    texts = list(INT_OK) + INT_NULL
    got = _eval(spark, texts, casts.safe_int)
    assert got == list(INT_OK.values()) + [None] * len(INT_NULL)


def test_float_edges(spark):
    texts = FLOAT_OK + FLOAT_NULL
    got = _eval(spark, texts, casts.safe_float)
    for t, g in zip(texts, got):
        assert _same_float(g, _py_float32(t)), t


def test_date_edges(spark):
    texts = list(DATE_OK) + DATE_NULL
    got = _eval(spark, texts, casts.safe_date)
    assert got == list(DATE_OK.values()) + [None] * len(DATE_NULL)


def test_datetime_edges(spark):
    texts = list(TS_OK) + TS_NULL
    got = _eval(spark, texts, casts.safe_datetime)
    assert got == list(TS_OK.values()) + [None] * len(TS_NULL)


def test_fractional_edges(spark):
    texts = list(FRAC_OK) + FRAC_NULL
    got = _eval(spark, texts, casts.safe_fractional_timestamp)
    assert got == list(FRAC_OK.values()) + [None] * len(FRAC_NULL)


def test_datetime_result_is_zone_free(spark):
    df = spark.createDataFrame([("8/31/2014 22:31",)], "t string")
    assert df.select(casts.safe_datetime("t").alias("v")).schema["v"].dataType.typeName() == "timestamp_ntz"


# --- brute force against Python on generated texts ----------------------------

_num_alphabet = st.sampled_from(list("0123456789+-.eE ") + ["nan", "inf", "inity", "f", "x", "_"])
_num_text = st.lists(_num_alphabet, min_size=0, max_size=8).map("".join)
_date_alphabet = st.sampled_from(list("0123456789/: ") + ["20", "19", "12", "31", "29", "02"])
_date_text = st.lists(_date_alphabet, min_size=0, max_size=12).map("".join)


@settings(max_examples=12, deadline=None)
@given(st.lists(_num_text, min_size=1, max_size=40))
def test_numbers_match_python(spark, texts):
    ints = _eval(spark, texts, casts.safe_int)
    floats = _eval(spark, texts, casts.safe_float)
    for t, i, f in zip(texts, ints, floats):
        assert i == _py_int(t), repr(t)
        assert _same_float(f, _py_float32(t)), repr(t)


@settings(max_examples=12, deadline=None)
@given(st.lists(_date_text, min_size=1, max_size=40))
def test_dates_match_python(spark, texts):
    dates = _eval(spark, texts, casts.safe_date)
    stamps = _eval(spark, texts, casts.safe_datetime)
    for t, d, s in zip(texts, dates, stamps):
        pd_ = _py_strptime(t, casts.DATE_FORMAT)
        ps = _py_strptime(t, casts.DATETIME_FORMAT)
        assert d == (pd_.date() if pd_ else None), repr(t)
        assert s == ps, repr(t)


_frac_alphabet = st.sampled_from(list("0123456789-:. ") + ["2014", "12", "31", "59", "60", "123456", "1234567"])
_frac_text = st.lists(_frac_alphabet, min_size=0, max_size=14).map("".join)


@settings(max_examples=12, deadline=None)
@given(st.lists(_frac_text, min_size=1, max_size=40))
def test_fractional_matches_python(spark, texts):
    got = _eval(spark, texts, casts.safe_fractional_timestamp)
    for t, g in zip(texts, got):
        assert g == _py_strptime(t, casts.FRACTIONAL_FORMAT), repr(t)


def test_fractional_valid_texts_match_python(spark):
    texts = ["2014-08-31 22:31:05.1", "2014-8-3 2:1:5.12", "2014-08- 3 02:01:05.000001",
             "2014-12-31  23:59:59.999999", "2016-02-29 00:00:00.5", "2015-02-29 00:00:00.5",
             "2014-08-31 22:31:61.1", "2014-08-31 24:00:00.1"]
    got = _eval(spark, texts, casts.safe_fractional_timestamp)
    assert got == [_py_strptime(t, casts.FRACTIONAL_FORMAT) for t in texts]


# --- the SQL-text forms used by wide projections -------------------------------

def _eval_sql(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    staged = df.selectExpr("i", "t", f"{casts.text_parts_sql('t', casts.DATE_PATTERN)} AS pd",
                           f"{casts.text_parts_sql('t', casts.DATETIME_PATTERN)} AS pt",
                           f"{casts.text_parts_sql('t', casts.FRACTIONAL_PATTERN)} AS pf")
    rows = staged.selectExpr("i", f"{fn} AS v").collect()
    return [r["v"] for r in sorted(rows, key=lambda r: r["i"])]


def _check_sql_forms(spark, texts):
    assert _eval_sql(spark, texts, casts.int_sql("t")) == [_py_int(t) for t in texts]
    for t, g in zip(texts, _eval_sql(spark, texts, casts.float_sql("t"))):
        assert _same_float(g, _py_float32(t)), repr(t)
    dates = _eval_sql(spark, texts, casts.date_from_parts_sql("pd"))
    stamps = _eval_sql(spark, texts, casts.datetime_from_parts_sql("pt"))
    fracs = _eval_sql(spark, texts, casts.fractional_from_parts_sql("pf"))
    for t, d, s, f in zip(texts, dates, stamps, fracs):
        pd_ = _py_strptime(t, casts.DATE_FORMAT)
        assert d == (pd_.date() if pd_ else None), repr(t)
        assert s == _py_strptime(t, casts.DATETIME_FORMAT), repr(t)
        assert f == _py_strptime(t, casts.FRACTIONAL_FORMAT), repr(t)


def test_sql_forms_on_edge_tables(spark):
    texts = (list(INT_OK) + INT_NULL + FLOAT_OK + FLOAT_NULL + list(DATE_OK) + DATE_NULL
             + list(TS_OK) + TS_NULL + list(FRAC_OK) + FRAC_NULL)
    _check_sql_forms(spark, texts)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(_num_text, _date_text, _frac_text), min_size=1, max_size=40))
def test_sql_forms_match_python(spark, texts):
    _check_sql_forms(spark, texts)


TERMINATORS = ["\n", "\r", "\r\n", "\u0085", "\u2028", "\u2029"]
FORMS = [
    (casts.safe_date, casts.DATE_PATTERN, casts.date_from_parts_sql, "8/31/2014", casts.DATE_FORMAT),
    (casts.safe_datetime, casts.DATETIME_PATTERN, casts.datetime_from_parts_sql, "8/31/2014 22:31", casts.DATETIME_FORMAT),
    (casts.safe_fractional_timestamp, casts.FRACTIONAL_PATTERN, casts.fractional_from_parts_sql,
     "2014-08-31 22:31:05.25", casts.FRACTIONAL_FORMAT),
]


@pytest.mark.parametrize("cast,pattern,from_parts,text,form", FORMS)
def test_line_terminators_at_the_end_give_null_in_both_forms(spark, cast, pattern, from_parts, text, form):
    texts = [text, *(text + t for t in TERMINATORS)]
    want = [_py_strptime(t, form) for t in texts]
    assert want[0] is not None and want[1:] == [None] * len(TERMINATORS)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    columns = [r.v is not None for r in df.select("i", cast("t").alias("v")).orderBy("i").collect()]
    parts = df.selectExpr("i", f"{casts.text_parts_sql('t', pattern)} AS p")
    sql = [r.v is not None for r in parts.selectExpr("i", f"{from_parts('p')} AS v").orderBy("i").collect()]
    assert columns == sql == [w is not None for w in want]
