"""W1 and A6 from state that is kept per period and merged.

A station's average and shares are quotients of sums. ``group_state`` computes those sums over one period's
rows, one row per key; they are stored per period and added up on reading, so a new period costs a scan of
that period alone, and a period that is loaded again replaces its own sums. Values are summed as integers,
so the merged figures equal those over all rows at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veloframe.functions.compare import share
from veloframe.functions.dates import WEEKDAY, WEEKEND
from veloframe.operators.relational import attach
from veloframe.sources.catalog import cut_lineage, drop_files
from veloframe.sources.periods import read_periods, replace_period

SUMS = ("n", "n_value", "sum_value", "weekday_trips", "weekend_trips")


def state_schema(key: str) -> T.StructType:
    return T.StructType([T.StructField(key, T.StringType()), *[T.StructField(c, T.LongType()) for c in SUMS]])


def group_state(df: DataFrame, key: str = "start_station", value: str = "duration",
                cls: str = "start_dow") -> DataFrame:
    """Sums of one period's rows per key: rows, values and their sum, rows by day class. NULL keys form a
    group; ``value`` must be of an integer type."""
    if not isinstance(df.schema[value].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"{value} must be of an integer type, so that sums merge exactly")
    return df.groupBy(F.col(key).cast("string").alias(key)).agg(
        F.count(F.lit(1)).alias("n"), F.count(value).alias("n_value"), F.sum(F.col(value).cast("long")).alias("sum_value"),
        F.count_if(F.col(cls) == WEEKDAY).alias("weekday_trips"), F.count_if(F.col(cls) == WEEKEND).alias("weekend_trips"))


def save_state(state: DataFrame, path: str, period: str) -> None:
    """Store a period's sums in place of those it had."""
    state = cut_lineage(state, "state")
    replace_period(state, path, period)
    drop_files(state)


def merged_state(spark: SparkSession, path: str, key: str = "start_station",
                 periods: list[str] | None = None) -> DataFrame:
    """Sums over the stored periods, one row per key."""
    stored = read_periods(spark, path, state_schema(key), periods)
    return stored.groupBy(key).agg(*[F.sum(c).alias(c) for c in SUMS])


def state_features(state: DataFrame, key: str = "start_station") -> DataFrame:
    """Per key the rows, the mean value and the two shares; a NULL key has a mean and no shares."""
    named = F.col(key).isNotNull()
    return state.select(
        key, F.col("n").alias("__rows"), (F.col("sum_value") / F.col("n_value")).alias("average"),
        F.when(named, share(F.col("weekday_trips"), F.col("n"))).alias("pct_weekday"),
        F.when(named, share(F.col("weekend_trips"), F.col("n"))).alias("pct_weekend"))


def with_state_features(df: DataFrame, state: DataFrame, key: str = "start_station") -> DataFrame:
    """Mean and shares of the merged state on every row; NULL for a key that the state lacks."""
    return attach(df, state_features(state, key), key, null_safe=True, weight="__rows")
