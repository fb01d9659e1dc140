"""Safe text -> value casts (Column -> Column).

The trip files are parsed field by field with "safe" conversions: a text
that does not parse becomes NULL instead of failing the job. The accepted
grammar is that of Python's ``int()``, ``float()`` and
``datetime.strptime``; these helpers reproduce it with native Spark
expressions (regex guard + ``try_*`` functions), so parsing stays inside
whole-stage code generation and never leaves the JVM.

Dates and timestamps are assembled from the matched parts with
``try_make_timestamp_ntz``, which makes the result zone-free regardless of
the session's default timestamp type and turns impossible calendar values
(2/30, hour 24, minute 60) into NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The accepted text grammar.
#
# Number grammar of Python's int() and float() (blanks around, optional sign,
# no digit separators, float also takes nan / inf / infinity in any case).
INT_PATTERN = r"^\s*[+-]?\d+\s*\z"
FLOAT_PATTERN = (r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
                 r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*\z")
# Field patterns of strptime directives: %m, %d, %Y, %H, %M, %S, %f.
# A blank in a strptime format matches one or more whitespace characters.
MONTH = r"(1[0-2]|0[1-9]|[1-9])"
DAY = r"(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])"
YEAR = r"(\d\d\d\d)"
HOUR = r"(2[0-3]|[0-1]\d|\d)"
MINUTE = r"([0-5]\d|\d)"
SECOND = r"(6[0-1]|[0-5]\d|\d)"
FRACTION = r"([0-9]{1,6})"
# Formats used by the trip, station and weather files.
DATE_FORMAT = "%m/%d/%Y"
DATETIME_FORMAT = "%m/%d/%Y %H:%M"
FRACTIONAL_FORMAT = "%Y-%m-%d %H:%M:%S.%f"
# ---------------------------------------------------------------------------

# \z is the end of the text; $ would also match before a last line terminator.
DATE_PATTERN = "^" + MONTH + "/" + DAY + "/" + YEAR + r"\z"
DATETIME_PATTERN = "^" + MONTH + "/" + DAY + "/" + YEAR + r"\s+" + HOUR + ":" + MINUTE + r"\z"
FRACTIONAL_PATTERN = ("^" + YEAR + "-" + MONTH + "-" + DAY + r"\s+" + HOUR + ":" + MINUTE
                      + ":" + SECOND + r"\." + FRACTION + r"\z")

# Separators between the numeric parts of a validated date/time text; a day
# written as " 5" (blank + digit) follows its separator.
_PART_SEPARATORS = r"[-/:.]\s*|\s+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_int(x) -> Column:
    """Python ``int(text)`` or NULL; out-of-range values are NULL too.

    The cast itself trims the surrounding blanks the guard allows.
    """
    x = _c(x)
    return F.when(x.rlike(INT_PATTERN), x.try_cast("int"))


def safe_long(x) -> Column:
    x = _c(x)
    return F.when(x.rlike(INT_PATTERN), x.try_cast("bigint"))


def safe_double(x) -> Column:
    """Python ``float(text)`` or NULL (64-bit)."""
    x = _c(x)
    return F.when(x.rlike(FLOAT_PATTERN), x.try_cast("double"))


def safe_float(x) -> Column:
    """Python ``float(text)`` narrowed to a 32-bit float, or NULL.

    Parsed to double first and narrowed after, as a Python float stored in a
    32-bit column is; parsing straight to float could round differently.
    """
    return safe_double(x).cast("float")


def text_parts(x, pattern: str) -> Column:
    """Stage 1 of a date/time cast: the numeric parts of a text matching
    ``pattern`` as an array of strings (NULL when it does not match).

    One regex match validates the text and one split cuts it. Project this
    array as its own column when several parts are read from it, so the
    split runs once per row (``parse_lines`` does).
    """
    x = _c(x)
    return F.split(F.when(x.rlike(pattern), x), _PART_SEPARATORS)


def _ints(parts: Column, n: int) -> list[Column]:
    return [F.get(parts, i).try_cast("int") for i in range(n)]


def date_from_parts(parts) -> Column:
    """Stage 2 of ``safe_date``: [month, day, year] -> DATE or NULL."""
    m, d, y = _ints(_c(parts), 3)
    ts = F.try_make_timestamp_ntz(y, m, d, F.lit(0), F.lit(0), F.lit(0))
    return F.when(y >= 1, ts.cast("date"))


def datetime_from_parts(parts) -> Column:
    """Stage 2 of ``safe_datetime``: [month, day, year, hour, minute] -> TIMESTAMP_NTZ or NULL."""
    m, d, y, hh, mi = _ints(_c(parts), 5)
    ts = F.try_make_timestamp_ntz(y, m, d, hh, mi, F.lit(0))
    return F.when(y >= 1, ts)


def fractional_from_parts(parts) -> Column:
    """Stage 2 of ``safe_fractional_timestamp``: [y, m, d, H, M, S, fraction] -> TIMESTAMP_NTZ.

    The fraction has 1 to 6 digits and is read right-padded (``.1`` is
    100000 microseconds). Seconds 60 and 61 match the pattern but are not a
    valid time, so they give NULL.
    """
    parts = _c(parts)
    y, m, d, hh, mi, ss = _ints(parts, 6)
    sec = F.concat(F.lpad(F.get(parts, 5), 2, "0"), F.lit("."),
                   F.rpad(F.get(parts, 6), 6, "0")).try_cast("decimal(8,6)")
    ts = F.try_make_timestamp_ntz(y, m, d, hh, mi, sec)
    return F.when((y >= 1) & (ss < 60), ts)


# strptime format -> (validating pattern, stage-2 builder)
STAGED = {
    DATE_FORMAT: (DATE_PATTERN, date_from_parts),
    DATETIME_FORMAT: (DATETIME_PATTERN, datetime_from_parts),
    FRACTIONAL_FORMAT: (FRACTIONAL_PATTERN, fractional_from_parts),
}


def safe_date(x) -> Column:
    """``strptime(text, '%m/%d/%Y')`` as a DATE, or NULL."""
    return date_from_parts(text_parts(x, DATE_PATTERN))


def safe_datetime(x) -> Column:
    """``strptime(text, '%m/%d/%Y %H:%M')`` as TIMESTAMP_NTZ, or NULL."""
    return datetime_from_parts(text_parts(x, DATETIME_PATTERN))


def safe_fractional_timestamp(x) -> Column:
    """``strptime(text, '%Y-%m-%d %H:%M:%S.%f')`` as TIMESTAMP_NTZ, or NULL."""
    return fractional_from_parts(text_parts(x, FRACTIONAL_PATTERN))


# ---------------------------------------------------------------------------
# The same casts as SQL expression text, for wide projections: a record with
# dozens of fields is then built with one ``selectExpr`` call (parsed on the
# JVM side) instead of thousands of Python -> JVM calls. The Column builders
# above and these templates express the same rules; the tests check both
# against Python's own parsers.

def _raw(pattern: str) -> str:
    """A raw SQL string literal (no escape processing)."""
    if "'" in pattern:
        raise ValueError("pattern must not contain a quote")
    return f"r'{pattern}'"


def int_sql(x: str, sql_type: str = "INT") -> str:
    return f"CASE WHEN {x} RLIKE {_raw(INT_PATTERN)} THEN try_cast({x} AS {sql_type}) END"


def double_sql(x: str) -> str:
    return f"CASE WHEN {x} RLIKE {_raw(FLOAT_PATTERN)} THEN try_cast({x} AS DOUBLE) END"


def float_sql(x: str) -> str:
    return f"CAST({double_sql(x)} AS FLOAT)"


def text_parts_sql(x: str, pattern: str) -> str:
    return f"split(CASE WHEN {x} RLIKE {_raw(pattern)} THEN {x} END, {_raw(_PART_SEPARATORS)})"


def _int_at(parts: str, i: int) -> str:
    return f"try_cast(get({parts}, {i}) AS INT)"


def date_from_parts_sql(p: str) -> str:
    m, d, y = (_int_at(p, i) for i in range(3))
    return f"CASE WHEN {y} >= 1 THEN CAST(try_make_timestamp_ntz({y}, {m}, {d}, 0, 0, 0) AS DATE) END"


def datetime_from_parts_sql(p: str) -> str:
    m, d, y, hh, mi = (_int_at(p, i) for i in range(5))
    return f"CASE WHEN {y} >= 1 THEN try_make_timestamp_ntz({y}, {m}, {d}, {hh}, {mi}, 0) END"


def fractional_from_parts_sql(p: str) -> str:
    y, m, d, hh, mi, ss = (_int_at(p, i) for i in range(6))
    sec = f"try_cast(concat(lpad(get({p}, 5), 2, '0'), '.', rpad(get({p}, 6), 6, '0')) AS DECIMAL(8,6))"
    return (f"CASE WHEN {y} >= 1 AND {ss} < 60 "
            f"THEN try_make_timestamp_ntz({y}, {m}, {d}, {hh}, {mi}, {sec}) END")


STAGED_SQL = {
    DATE_FORMAT: (DATE_PATTERN, date_from_parts_sql),
    DATETIME_FORMAT: (DATETIME_PATTERN, datetime_from_parts_sql),
    FRACTIONAL_FORMAT: (FRACTIONAL_PATTERN, fractional_from_parts_sql),
}
