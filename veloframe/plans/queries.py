"""The query catalog: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query reads the whole benchmark tables (or views Spark derives from
them, see ``sources.fixtures``) and exercises one operator or job of the
inventory. Row-level outputs keep ``trip_id`` so unordered results compare
row by row. Outputs use int, bigint, double, float, string, date and
zone-free timestamps only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.operators import encode, learn, state
from veloframe.operators import features as feat
from veloframe.operators import relational as rel
from veloframe.plans import jobs
from veloframe.plans.fitted import fit_trips, load_fitted
from veloframe.sources import fixtures as fx
from veloframe.sources.bucketed import join_bucketed, save_bucketed_pair
from veloframe.sources.catalog import cut_lineage, read_table, save_table, shared_path
from veloframe.sources.ingest import CheckedLoad, load_checked, load_delimited, parse_lines
from veloframe.sources.periods import PeriodTable
from veloframe.sources.schemas import (
    STATION_SCHEMA,
    TRIP_REQUIRED_TEXT,
    TRIP_SCHEMA,
    WEATHER_SCHEMA,
)
from veloframe.functions import casts

Query = Callable[[SparkSession, str], DataFrame]

# First part of the name of the table that the round trip writes.
FEATURE_TABLE = "veloframe_trip_features"

SEED = 42
#: Buckets of the stored join's tables.
BUCKETS = 16


# --- ingest (S1-S7, F1-F5) ---------------------------------------------------

def parse_trip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip text lines (header first) -> typed trips."""
    lines = fx.with_header(spark, fx.trip_lines(spark, sf_dir), fx.TRIP_HEADER)
    return parse_lines(lines, TRIP_SCHEMA, header=fx.TRIP_HEADER)


def parse_station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 (station), F1-F3: station text lines -> typed stations."""
    lines = fx.with_header(spark, fx.station_lines(spark, sf_dir), fx.STATION_HEADER)
    return parse_lines(lines, STATION_SCHEMA, header=fx.STATION_HEADER)


def parse_weather_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 (weather), F1-F3: weather text lines -> 24 typed columns."""
    lines = fx.with_header(spark, fx.weather_lines(spark, sf_dir), fx.WEATHER_HEADER)
    return parse_lines(lines, WEATHER_SCHEMA, header=fx.WEATHER_HEADER)


def load_trip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1-S7 + O2 from files: the halves written as period files (each
    beginning with its own header), scanned as text, each period's header
    taken from its first line, incomplete trips dropped."""
    folders = fx.write_trip_period_files(spark, sf_dir, shared_path(spark, "trip_files", uuid.uuid4().hex))
    return load_delimited(spark, folders, TRIP_SCHEMA, header="first", required_text=TRIP_REQUIRED_TEXT)


def load_mixed_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1-S6 per file: one folder whose files have three different headers, each dropped from its own file."""
    folder = shared_path(spark, "mixed_files", uuid.uuid4().hex)
    fx.write_mixed_folder(spark, sf_dir, folder)
    return load_delimited(spark, folder, TRIP_SCHEMA, header="file")


def _checked_folder(spark: SparkSession, sf_dir: str) -> CheckedLoad:
    folder = shared_path(spark, "checked_files", uuid.uuid4().hex)
    fx.write_mixed_folder(spark, sf_dir, folder, ill_formed=True)
    return load_checked(spark, folder, TRIP_SCHEMA)


def checked_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 with rejects: the rows of well-formed lines."""
    return _checked_folder(spark, sf_dir).good


def checked_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 with rejects: every short or unparsable line with the reason, and the pass's own counts."""
    found = _checked_folder(spark, sf_dir)
    counts = [F.lit(found.counts[k]).cast("bigint").alias(f"n_{k}") for k in ("lines", "short", "unparsable", "rejected")]
    return found.rejects.select("line", "reason", F.col("file").isNotNull().cast("int").alias("has_file"), *counts)


def _cast_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text variants built from every event, cycling through edge cases."""
    ev = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    k, b = F.col("event_id"), F.col("user_id").cast("string")
    y, m, d = F.year("ts").cast("string"), F.month("ts").cast("string"), F.dayofmonth("ts").cast("string")
    hh, mi = F.hour("ts").cast("string"), F.minute("ts").cast("string")
    a2 = F.lpad((k % 100).cast("string"), 2, "0")
    mdy = F.concat_ws("/", m, d, y)
    hm = F.concat(hh, F.lit(":"), F.lpad(mi, 2, "0"))
    micro = F.date_format("ts", "SSSSSS")
    whole = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")

    def pick(r, options):
        expr = None
        for i, o in enumerate(options):
            expr = F.when(r == i, o) if expr is None else expr.when(r == i, o)
        return expr

    t_int = pick(k % 8, [b, F.concat(F.lit(" "), b, F.lit(" ")), F.concat(F.lit("+"), b),
                         F.concat(F.lit("-"), b), F.concat(b, F.lit(".0")), F.concat(b, F.lit("e3")),
                         F.concat(F.lit("1_"), b), F.lit("")])
    t_float = pick(k % 10, [F.concat(b, F.lit("."), a2), F.concat(F.lit(" "), b, F.lit(".5 ")),
                            F.lit("nan"), F.lit("-inf"), F.lit("Infinity"), F.concat(b, F.lit(".0f")),
                            F.concat(F.lit("."), b), F.concat(b, F.lit("e-2")), F.lit("0x1p3"),
                            F.concat(b, F.lit("."))])
    t_date = pick(k % 7, [mdy, F.concat_ws("/", F.lpad(m, 2, "0"), F.lpad(d, 2, "0"), y),
                          F.concat(F.lit("2/30/"), y),
                          F.concat_ws("/", m, d, F.lpad((F.year("ts") % 100).cast("string"), 2, "0")),
                          F.concat(F.lit(" "), mdy), F.concat(mdy, F.lit(" 1:00")), F.lit("")])
    t_ts = pick(k % 8, [F.concat(mdy, F.lit(" "), hm),
                        F.concat(F.concat_ws("/", F.lpad(m, 2, "0"), F.lpad(d, 2, "0"), y),
                                 F.lit(" "), hh, F.lit(":"), mi),
                        F.concat(mdy, F.lit("  "), hm),
                        F.concat(mdy, F.lit(" 24:00")),
                        F.concat(mdy, F.lit(" "), hh, F.lit(":60")),
                        F.concat(F.lit(" "), mdy, F.lit(" "), hm),
                        F.concat(mdy, F.lit(" 0"), F.lpad(hh, 2, "0"), F.lit(":"), F.lpad(mi, 2, "0")),
                        F.concat(F.lit("2/29/"), y, F.lit(" 0:0"))])
    t_frac = pick(k % 6, [F.concat(whole, F.lit("."), micro),
                          F.concat(whole, F.lit("."), F.substring(micro, 1, 1)),
                          whole,
                          F.concat(whole, F.lit("."), micro, F.lit("0")),
                          F.concat(whole, F.lit(".")),
                          F.concat(F.concat_ws("-", y, m, d), F.lit(" "),
                                   F.concat_ws(":", hh, mi, F.second("ts").cast("string")),
                                   F.lit("."), F.substring(micro, 1, 2))])
    return ev.select("event_id", t_int.alias("t_int"), t_float.alias("t_float"),
                     t_date.alias("t_date"), t_ts.alias("t_ts"), t_frac.alias("t_frac"))


def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1-F5 on texts derived from every event row."""
    t = _cast_texts(spark, sf_dir).select(
        "*",
        casts.text_parts("t_date", casts.DATE_PATTERN).alias("p_date"),
        casts.text_parts("t_ts", casts.DATETIME_PATTERN).alias("p_ts"),
        casts.text_parts("t_frac", casts.FRACTIONAL_PATTERN).alias("p_frac"))
    return t.select("event_id",
                    "t_int", casts.safe_int("t_int").alias("as_int"),
                    "t_float", casts.safe_float("t_float").alias("as_float"),
                    "t_date", casts.date_from_parts("p_date").alias("as_date"),
                    "t_ts", casts.datetime_from_parts("p_ts").alias("as_ts"),
                    "t_frac", casts.fractional_from_parts("p_frac").alias("as_frac"))


def header_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header in front, again between the halves, and once with a blank.

    Every exact header line is dropped; the near-header stays as data (its
    numbers parse to NULL).
    """
    lines = fx.trip_lines(spark, sf_dir)
    first, second = fx.trip_halves(lines.withColumnRenamed("_start", "start_date"))
    head = spark.range(1).select(F.lit(fx.TRIP_HEADER).alias("value"))
    near = spark.range(1).select(F.lit(fx.TRIP_HEADER.replace(",", ", ", 1)).alias("value"))
    allx = rel.stack(head, first.select("value"), head, second.select("value"), near)
    parsed = parse_lines(allx, TRIP_SCHEMA, header=fx.TRIP_HEADER)
    return parsed.agg(F.count(F.lit(1)).alias("n"),
                      F.count_if(F.col("trip_id").isNull()).alias("n_null_trip_id"))


# --- relational (R2, U1, A1-A6, J1, W1, F7-F11, S8-S9) ------------------------

def non_empty_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: trips with '' or NULL in a required text field are dropped."""
    t = fx.trips(spark, sf_dir, "dirty")
    return rel.non_empty(t, TRIP_REQUIRED_TEXT).select("trip_id")


def stack_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 + A1: the two halves stacked; rows per half and in total, one pass."""
    first, second = fx.trip_halves(fx.trips(spark, sf_dir))
    return rel.part_counts({"first": first, "second": second}, tag="part", total="all")


def stack_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 keeps duplicates: trips stacked with themselves -> 2 per trip."""
    t = fx.trips(spark, sf_dir)
    return rel.stack(t, t).groupBy("trip_id").agg(F.count(F.lit(1)).alias("n"))


def days_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 + R5: duration overwritten by whole days between start and end."""
    t = feat.with_days_between(fx.trips(spark, sf_dir), "end_date", "start_date", "duration")
    return t.select("trip_id", "duration")


def station_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average duration of the start station (NULL stations form a group)."""
    t = feat.with_group_average(fx.trips(spark, sf_dir, "nulls"), "start_station", "duration")
    return t.select("trip_id", "average")


def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: start station equals end station (NULL equals NULL)."""
    t = feat.with_equal_flag(fx.trips(spark, sf_dir, "nulls"), "start_station", "end_station")
    return t.select("trip_id", "round_trip")


def day_of_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekday number and class of the start."""
    t = feat.with_day_of_week(fx.trips(spark, sf_dir), "start_date")
    return t.select("trip_id", "start_day", "start_dow")


def trips_per_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + O1: trips per weekday number, in weekday order."""
    t = feat.with_day_of_week(fx.trips(spark, sf_dir), "start_date")
    return rel.group_count(t, "start_day", "n")


def station_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3-A5: per station weekday/weekend counts, total and rounded shares."""
    t = feat.with_day_of_week(fx.trips(spark, sf_dir, "nulls"), "start_date")
    return feat.group_class_shares(t, "start_station", "start_dow", keep_counts=True)


def shares_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + J1 + R7: shares joined back to every trip; NULL station -> NULL."""
    t = feat.with_day_of_week(fx.trips(spark, sf_dir, "nulls"), "start_date")
    return feat.with_group_shares(t).select("trip_id", "pct_weekday", "pct_weekend")


def first_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: the first 20 trips by trip id (a top-n report: the limit is the feature)."""
    t = fx.trips(spark, sf_dir).select("trip_id", "duration", "start_date", "start_station", "sub_type")
    return rel.first_rows(t, 20, ["trip_id"])


def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + S9: features written as a table of the run's own name, scanned back, counted."""
    t = feat.with_day_of_week(fx.trips(spark, sf_dir), "start_date")
    name, path = _run_table(spark, FEATURE_TABLE)
    save_table(t, name, mode="errorifexists", path=path)
    return rel.group_count(read_table(spark, name), "start_station", "n", ordered=False)


def _run_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """A table name and place that no other run uses."""
    name = f"{name}_{uuid.uuid4().hex}"
    return name, shared_path(spark, "tables", name)


def flagship_trip_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip with its six engineered features."""
    return feat.trip_features(fx.trips(spark, sf_dir))


def _loaded_periods(spark: SparkSession, sf_dir: str) -> PeriodTable:
    """The halves loaded as two periods; the first is loaded from the second's files, then again from its
    own, and the second twice, of which the manifest passes one over."""
    run = shared_path(spark, "period_tables", uuid.uuid4().hex)
    halves = dict(zip(("h1", "h2"), fx.write_trip_period_files(spark, sf_dir, f"{run}/in"), strict=True))
    table = PeriodTable(spark, f"{run}/table", TRIP_SCHEMA)
    for period, files in (("h1", "h2"), ("h2", "h2"), ("h1", "h1"), ("h2", "h2")):
        jobs.load_trip_period(table, period, halves[files])
    jobs.load_trip_period(table, "h2", halves["h2"], again=True)
    return table


def period_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a period table whose periods were loaded more than once."""
    t = _loaded_periods(spark, sf_dir).rows()
    return t.select("trip_id", "duration", "start_date", "start_station", "end_date", "zip", "period")


def incremental_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station average and shares on every loaded trip, from sums kept per period and merged."""
    t = jobs.trips_with_state(_loaded_periods(spark, sf_dir))
    return t.select("trip_id", "average", "pct_weekday", "pct_weekend")


def merged_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1, A6 on trips with NULL stations: equal to ``station_average`` and ``shares_joined`` after two
    periods' sums were stored, one of them twice."""
    t = feat.with_day_of_week(fx.trips(spark, sf_dir, "nulls"), "start_date")
    path = shared_path(spark, "station_state", uuid.uuid4().hex)
    first, second = fx.trip_halves(t)
    for period, part in (("h1", second), ("h2", second), ("h1", first)):
        state.save_state(state.group_state(part), path, period)
    return state.with_state_features(t, state.merged_state(spark, path)).select(
        "trip_id", "average", "pct_weekday", "pct_weekend")


# --- encoding (M1-M5) ---------------------------------------------------------

INDEX_CHECK_COLUMNS = ["start_station", "sub_type", "duration"]


def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: label table -- each value's rank by falling frequency, ties by text."""
    labels = encode.frequency_labels(fx.trips(spark, sf_dir), INDEX_CHECK_COLUMNS)
    return labels.select("col", "value", F.col("idx").cast("int").alias("idx"))


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + M2: per trip and column, the hot slot and the vector width, in one pass."""
    t = fx.trips(spark, sf_dir).select("trip_id", *INDEX_CHECK_COLUMNS)
    hot = encode.one_hot(encode.index_columns(t, INDEX_CHECK_COLUMNS), INDEX_CHECK_COLUMNS)
    found = F.array(*[F.struct(
        F.lit(c).alias("col"), _single(encode.entry_indices(c)).alias("slot"),
        F.regexp_extract(F.col(c).cast("string"), r"^\((\d+),", 1).cast("int").alias("width"))
        for c in INDEX_CHECK_COLUMNS])
    return hot.select("trip_id", F.inline(found))


def _single(indices):
    return F.when(F.size(indices) == 1, F.get(indices, 0))


def index_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: the later half of the trips indexed by the labels of the earlier one; a zip that only the
    later has gets the index past the last."""
    first, second = fx.trip_halves(fx.trips(spark, sf_dir).select("trip_id", "zip", "start_date"))
    labels = encode.frequency_labels(first, ["zip"])
    indexed = encode.index_columns(second.select("trip_id", "zip"), ["zip"], handle_invalid="keep", labels=labels)
    return indexed.select("trip_id", F.col("zip").cast("int").alias("idx"))


def assemble_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 + M3: all-feature vector width (from its metadata), row count and non-zero count."""
    d = jobs.all_features_points(fx.trips(spark, sf_dir))
    return d.select(F.size(encode.entry_indices("features")).alias("n")).agg(
        F.lit(encode.vector_width(d)).alias("size"), F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("nnz"))


def assemble_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + M3 + M4: [duration, start_terminal] vector and the indexed label."""
    t = fx.trips(spark, sf_dir).select("trip_id", "duration", "start_terminal", "sub_type")
    d = encode.index_columns(t, ["sub_type"])
    d = encode.assemble(d, jobs.BASELINE_INPUTS)
    pts = d.select("trip_id", vector_to_array("features").alias("f"), F.col("sub_type").alias("label"))
    return pts.select("trip_id", F.col("f")[0].alias("f0"), F.col("f")[1].alias("f1"), "label")


def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 (repeatable): rows per part of the md5-bucket 80/20 split."""
    train, valid = encode.split_by_hash(fx.trips(spark, sf_dir), "trip_id")
    return rel.part_counts({"train": train, "valid": valid}, tag="part", total=None)


def split_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 (seeded draw): rows of both parts together, and how many trips they hold."""
    train, valid = encode.split_random(fx.trips(spark, sf_dir).select("trip_id"), (0.8, 0.2), SEED)
    both = rel.stack(train, valid)
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("trip_id").alias("n_trips"))


def split_random_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 (seeded draw): the part that each trip falls into."""
    train, valid = encode.split_random(fx.trips(spark, sf_dir).select("trip_id"), (0.8, 0.2), SEED, "trip_id")
    return rel.stack_tagged({"train": train, "valid": valid}, tag="part")


def bucketed_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares joined to every trip bucket by bucket, from two stored tables; NULL station -> NULL."""
    t = feat.with_day_of_week(fx.trips(spark, sf_dir, "nulls"), "start_date").select("trip_id", "start_station", "start_dow")
    t = cut_lineage(t, "trips")  # written once: read for the shares and for the buckets
    shares = feat.group_class_shares(t, "start_station", "start_dow").select(
        "start_station", "total_trips", "pct_weekday", "pct_weekend")
    tables = [_run_table(spark, f"veloframe_bucketed_{part}") for part in ("trips", "shares")]
    pair = save_bucketed_pair(t, cut_lineage(shares, "shares"), "start_station", "total_trips",
                              tuple(n for n, _ in tables), BUCKETS, tuple(p for _, p in tables))
    return join_bucketed(spark, pair).select("trip_id", "pct_weekday", "pct_weekend")


# --- learning (M6-M12) and jobs (P1-P6) ---------------------------------------

def rf_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random forest on [duration, start_terminal]."""
    return jobs.baseline_job(fx.trips(spark, sf_dir), SEED, models=("random_forest",))


def dt_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision tree on [duration, start_terminal]."""
    return jobs.baseline_job(fx.trips(spark, sf_dir), SEED, models=("decision_tree",))


def lr_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression on all one-hot features, md5 split."""
    points = jobs.all_features_points(fx.trips(spark, sf_dir))
    return jobs.train_and_measure(points, ["logistic_regression"], SEED, indicators=True).select("accuracy")


def _by_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips whose label the start terminal decides, so that a tree must find it."""
    return fx.trips(spark, sf_dir, "by_terminal")


TREES = ("random_forest", "decision_tree")


def trees_by_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forest and tree find a label that start_terminal decides."""
    return jobs.baseline_job(_by_terminal(spark, sf_dir), SEED, models=TREES)


def window_job_by_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 on the same label."""
    return jobs.window_features_job(_by_terminal(spark, sf_dir), SEED, models=TREES)


def all_features_by_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 on the same label: a tree over the one-hot stations."""
    halves = fx.trip_halves(_by_terminal(spark, sf_dir))
    return jobs.all_features_job(halves, SEED, models=("decision_tree",))


def all_features_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 through its table: written, shares computed from it and joined back."""
    name, path = _run_table(spark, "veloframe_all_features")
    t = jobs.all_features(fx.trips(spark, sf_dir, "nulls"), name, path)
    return t.select("trip_id", "average", "round_trip", "start_day", "start_dow", "pct_weekday", "pct_weekend")


def lr_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8, M9: every validation trip's label, prediction, and whether its probability is above one half;
    logistic regression without penalty on the one-hot station, which decides the label."""
    points = jobs.station_points(_by_terminal(spark, sf_dir))
    scored = jobs.scored_trips(points, learn.logistic_regression(reg_param=0.0, elastic_net=0.0))
    p = vector_to_array("probability")
    return scored.select("trip_id", "label", "prediction",
                         (F.get(p, F.col("prediction").cast("int")) > 0.5).cast("int").alias("above_half"))


def dt_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7, M9: the tree of ``dt_accuracy`` as a rule table, scored by joins and held against the model by row."""
    return jobs.rule_mismatches(jobs.baseline_points(fx.trips(spark, sf_dir)), learn.decision_tree(SEED))


def rf_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6, M9: the same for the forest of ``rf_accuracy``."""
    return jobs.rule_mismatches(jobs.baseline_points(fx.trips(spark, sf_dir)), learn.random_forest(SEED))


def lr_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 with its penalty, all features: the fit keeps coefficients and is at the penalised optimum."""
    report = jobs.penalised_fit_report(jobs.all_features_points(fx.trips(spark, sf_dir, "by_day")))
    return report.select("n", (F.col("active") > 0).cast("int").alias("has_coefficients"), "optimal")


def job_baseline_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4's penalised logistic regression on a label that the start terminal's half decides."""
    return jobs.baseline_job(fx.trips(spark, sf_dir, "by_half"), SEED, models=("logistic_regression",))


def job_window_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5's, with its features written as a table first."""
    name, path = _run_table(spark, "veloframe_window_features")
    return jobs.window_features_job(fx.trips(spark, sf_dir, "by_half"), SEED, models=("logistic_regression",),
                                    table_name=name, table_path=path)


def job_all_features_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6's penalised logistic regression on a label that the kind of day decides."""
    return jobs.all_features_job(fx.trip_halves(fx.trips(spark, sf_dir, "by_day")), SEED)


def job_random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 with the seeded random split, as the original jobs split."""
    return jobs.baseline_job(_by_terminal(spark, sf_dir), SEED, models=TREES, split="random")


def window_features_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5's features (W1, F8) on every trip, as its job writes them."""
    name, path = _run_table(spark, "veloframe_window_features")
    save_table(jobs.window_features(fx.trips(spark, sf_dir, "nulls")), name, path=path)
    return read_table(spark, name).select("trip_id", "average", "round_trip")


def fitted_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M3, M8, M9: a classifier fitted on the first half, stored, loaded by another session, and used on
    the second half: the class it gives each trip, and whether the unstored one gives the same row."""
    first, second = fx.trip_halves(fx.trips(spark, sf_dir, "by_day"))
    fitted = fit_trips(first)
    path = shared_path(spark, "fitted", uuid.uuid4().hex)
    before, after = f"{path}/before", f"{path}/after"
    fitted.score(second).write.parquet(before)
    fitted.save(f"{path}/model")
    other = spark.newSession()
    _, later = fx.trip_halves(fx.trips(other, sf_dir, "by_day"))
    load_fitted(other, f"{path}/model").score(later).write.parquet(after)
    old = spark.read.parquet(before).select("trip_id", *[
        F.col(c).alias(f"old_{c}") for c in ("prediction", "probability", "predicted")])
    same = (F.col("prediction") == F.col("old_prediction")) & F.col("predicted").eqNullSafe(F.col("old_predicted")) & (
        vector_to_array("probability") == vector_to_array("old_probability"))
    return spark.read.parquet(after).join(old, "trip_id", "full").select(
        "trip_id", "predicted", F.coalesce(same, F.lit(False)).cast("int").alias("same"))


def accuracy_from_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10-M12 on (label, prediction) pairs: quality as label, toxic as prediction."""
    lab = fx.table(spark, sf_dir, "labels")
    scored = lab.select(F.col("quality").cast("double").alias("label"),
                        F.col("toxic").cast("double").alias("prediction"))
    return learn.accuracy_frame(scored)


def load_and_stack_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three datasets from text, two period files each, stacked, counted.

    Stations appear in both period files (kept twice); trips and weather are
    split by date.
    """
    tl = fx.trip_lines(spark, sf_dir).withColumnRenamed("_start", "start_date")
    t1, t2 = fx.trip_halves(tl)
    wl = fx.weather_lines(spark, sf_dir).withColumnRenamed("_date", "start_date")
    w1, w2 = fx.trip_halves(wl)
    st = fx.station_lines(spark, sf_dir)
    lines = {
        "station": [fx.with_header(spark, st, fx.STATION_HEADER),
                    fx.with_header(spark, st, fx.STATION_HEADER)],
        "trip": [fx.with_header(spark, t1.select("value"), fx.TRIP_HEADER),
                 fx.with_header(spark, t2.select("value"), fx.TRIP_HEADER)],
        "weather": [fx.with_header(spark, w1.select("value"), fx.WEATHER_HEADER),
                    fx.with_header(spark, w2.select("value"), fx.WEATHER_HEADER)],
    }
    schemas = {"station": STATION_SCHEMA, "trip": TRIP_SCHEMA, "weather": WEATHER_SCHEMA}
    headers = {"station": fx.STATION_HEADER, "trip": fx.TRIP_HEADER, "weather": fx.WEATHER_HEADER}
    return jobs.dataset_counts(jobs.load_and_stack(lines, schemas, headers))


def job_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline classification job (three models)."""
    return jobs.baseline_job(fx.trips(spark, sf_dir), SEED)


def job_window_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: window / round-trip feature job (three models)."""
    return jobs.window_features_job(fx.trips(spark, sf_dir), SEED)


def job_all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features from the two halves, one-hot, logistic regression."""
    first, second = fx.trip_halves(fx.trips(spark, sf_dir, "blanks"))
    return jobs.all_features_job([first, second], SEED)


def stream_trip_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beyond the survey (its jobs are batch only): S1-S6 + U1 as a stream: both halves written as period files, parsed and
    appended by one available-now streaming run, then summarised."""
    from veloframe.streaming import append_periods, read_period_stream

    run = uuid.uuid4().hex
    folder = shared_path(spark, "periods", run, "in")
    table_path = shared_path(spark, "periods", run, "table")
    lines = fx.trip_lines(spark, sf_dir).withColumnRenamed("_start", "start_date")
    for half in fx.trip_halves(lines):
        fx.with_header(spark, half.select("value"), fx.TRIP_HEADER).write.mode("append").text(folder)
    stream = read_period_stream(spark, folder, TRIP_SCHEMA, header=fx.TRIP_HEADER)
    append_periods(stream, table_path, f"trip_periods_{run}").awaitTermination()
    t = spark.read.schema(TRIP_SCHEMA).parquet(table_path)
    return t.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.col("duration").isNull()).alias("n_null_duration"),
                 F.count_if(F.col("start_date").isNull()).alias("n_null_start"))


QUERIES: dict[str, Query] = {
    "parse_trip_lines": parse_trip_lines,
    "parse_station_lines": parse_station_lines,
    "parse_weather_lines": parse_weather_lines,
    "load_trip_files": load_trip_files,
    "load_mixed_folder": load_mixed_folder,
    "checked_good": checked_good,
    "checked_rejects": checked_rejects,
    "safe_casts": safe_casts,
    "header_strip": header_strip,
    "non_empty_filter": non_empty_filter,
    "stack_counts": stack_counts,
    "stack_duplicates": stack_duplicates,
    "days_between": days_between,
    "station_average": station_average,
    "round_trip": round_trip,
    "day_of_week": day_of_week,
    "trips_per_weekday": trips_per_weekday,
    "station_shares": station_shares,
    "shares_joined": shares_joined,
    "first_trips": first_trips,
    "table_roundtrip": table_roundtrip,
    "flagship_trip_features": flagship_trip_features,
    "period_reload": period_reload,
    "incremental_features": incremental_features,
    "merged_features": merged_features,
    "string_index": string_index,
    "one_hot": one_hot,
    "assemble_size": assemble_size,
    "assemble_numeric": assemble_numeric,
    "split_hash": split_hash,
    "split_random": split_random,
    "split_random_rows": split_random_rows,
    "bucketed_shares": bucketed_shares,
    "dt_rules": dt_rules,
    "rf_rules": rf_rules,
    "lr_optimality": lr_optimality,
    "job_baseline_lr": job_baseline_lr,
    "job_window_lr": job_window_lr,
    "job_all_features_lr": job_all_features_lr,
    "job_random_split": job_random_split,
    "window_features_table": window_features_table,
    "fitted_scored": fitted_scored,
    "rf_accuracy": rf_accuracy,
    "dt_accuracy": dt_accuracy,
    "lr_accuracy": lr_accuracy,
    "accuracy_from_pairs": accuracy_from_pairs,
    "load_and_stack_jobs": load_and_stack_jobs,
    "job_baseline": job_baseline,
    "job_window_features": job_window_features,
    "job_all_features": job_all_features,
    "index_unseen": index_unseen,
    "trees_by_terminal": trees_by_terminal,
    "window_job_by_terminal": window_job_by_terminal,
    "all_features_by_terminal": all_features_by_terminal,
    "all_features_table": all_features_table,
    "lr_scored": lr_scored,
    "stream_trip_periods": stream_trip_periods,
}
