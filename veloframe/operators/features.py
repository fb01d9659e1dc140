"""Feature operators: group average, round-trip flag, day of week, shares.

All features are native expressions. The two per-station features (the
station's average duration and its weekday/weekend shares) are computed in
one grouped aggregate and attached with one join, instead of a window over
the station: a window would ship every trip column through a shuffle and
put a whole station, however large, into one task, while the aggregate is
pre-combined in every map task and the join back is size-checked, with
heavy keys split when the per-key side is too big to broadcast (see
``operators.relational``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veloframe.functions.compare import equal_flag, share
from veloframe.functions.dates import WEEKDAY, WEEKEND, day_class, day_number, days_between
from veloframe.operators.relational import attach, class_counts


def with_group_average(df: DataFrame, key: str, value: str, out: str = "average") -> DataFrame:
    """Mean of ``value`` over all rows with the same ``key``, on every row.

    Same result as ``avg(value) OVER (PARTITION BY key)``: NULL values are
    ignored and rows with a NULL key get the mean of the NULL-key group.
    """
    stats = df.groupBy(key).agg(F.avg(value).alias(out), F.count(F.lit(1)).alias("__rows"))
    return attach(df, stats, key, null_safe=True, weight="__rows")


def with_equal_flag(df: DataFrame, a: str, b: str, out: str = "round_trip") -> DataFrame:
    """F8: 1 where ``a`` equals ``b`` (NULL equals NULL), else 0."""
    return df.withColumn(out, equal_flag(a, b))


def with_day_of_week(df: DataFrame, ts: str, day: str = "start_day", cls: str = "start_dow") -> DataFrame:
    """Weekday number (Monday 0) and its weekday/weekend class."""
    return df.withColumn(day, day_number(ts)).withColumn(cls, day_class(F.col(day)))


def with_days_between(df: DataFrame, end: str, start: str, out: str = "duration") -> DataFrame:
    """F7 + R5: whole days from ``start`` to ``end`` (replaces ``out`` if present)."""
    return df.withColumn(out, days_between(end, start))


SHARE_CLASSES = {"weekday_trips": WEEKDAY, "weekend_trips": WEEKEND}
SHARE_NAMES = {"pct_weekday": "weekday_trips", "pct_weekend": "weekend_trips"}


def group_class_shares(df: DataFrame, key: str = "start_station", cls: str = "start_dow",
                       keep_counts: bool = True) -> DataFrame:
    """A3-A5: per key, weekday/weekend trip counts, total and rounded shares."""
    counts = class_counts(df, key, cls, SHARE_CLASSES)
    cols = [F.col(key)]
    if keep_counts:
        cols += [F.col("weekday_trips"), F.col("weekend_trips"), F.col("total_trips")]
    cols += [share(F.col(c), F.col("total_trips")).alias(n) for n, c in SHARE_NAMES.items()]
    return counts.select(*cols)


def with_group_shares(df: DataFrame, key: str = "start_station", cls: str = "start_dow") -> DataFrame:
    """A6 (A3-A5 + J1): per-key shares joined back; a NULL key gets NULL shares."""
    counts = class_counts(df, key, cls, SHARE_CLASSES)
    stats = counts.select(F.col(key), F.col("total_trips").alias("__rows"),
                          *[share(F.col(c), F.col("total_trips")).alias(n) for n, c in SHARE_NAMES.items()])
    return attach(df, stats, key, null_safe=False, weight="__rows")


def with_station_features(df: DataFrame, key: str = "start_station", value: str = "duration",
                          cls: str = "start_dow", average: str = "average") -> DataFrame:
    """W1 and A6 together: one aggregate per key, one join back.

    Rows with a NULL key get the NULL group's average (window semantics)
    and NULL shares (outer-join semantics), as the separate operators do.
    """
    counts = class_counts(df, key, cls, SHARE_CLASSES, extra={average: F.avg(value)})
    stats = counts.select(
        F.col(key), F.col(average), F.col("total_trips").alias("__rows"),
        *[share(F.col(c), F.col("total_trips")).alias(n) for n, c in SHARE_NAMES.items()])
    joined = attach(df, stats, key, null_safe=True, weight="__rows")
    return joined.withColumns({
        n: F.when(F.col(key).isNotNull(), F.col(n)) for n in SHARE_NAMES
    })


def trip_features(df: DataFrame) -> DataFrame:
    """All engineered trip features, appended in order: average, round_trip,
    start_day, start_dow, pct_weekday, pct_weekend."""
    base = df.columns
    d = with_equal_flag(df, "start_station", "end_station")
    d = with_day_of_week(d, "start_date")
    d = with_station_features(d)
    return d.select(*base, "average", "round_trip", "start_day", "start_dow",
                    "pct_weekday", "pct_weekend")
