"""User-level jobs composed from the operators.

Each job is composition only. Before a learner's iterations start, the
labelled points are written once to the checkpoint folder
(``cut_lineage``), so the iterations -- and any task retried after an
executor loss -- read those files instead of replaying scans, joins and
encoders; the two splits are then kept in executor memory.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veloframe.operators import encode, indicator_tree, learn, optimality, rules, state
from veloframe.operators import features as feat
from veloframe.operators.relational import non_empty, part_counts, stack
from veloframe.sources.catalog import cut_lineage, drop_files, keep, read_table, save_table
from veloframe.sources.ingest import parse_lines
from veloframe.sources.periods import PeriodLoad, PeriodTable
from veloframe.sources.schemas import TRIP_REQUIRED_TEXT

# Feature lists of the three classification jobs.
BASELINE_INDEXED = ["sub_type", "start_station", "end_station", "zip"]
BASELINE_INPUTS = ["duration", "start_terminal"]
ALL_INDEXED = ["sub_type", "start_station", "end_station", "zip", "duration", "round_trip",
               "average", "start_day", "start_dow"]
ALL_INPUTS = ["start_station", "end_station", "zip", "duration", "round_trip", "average",
              "start_day", "start_dow"]
LABEL_SOURCE = "sub_type"


def load_and_stack(lines: Mapping[str, Sequence[DataFrame]], schemas: Mapping[str, StructType],
                   headers: Mapping[str, str | None] | None = None,
                   required_text: Mapping[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """Parse each dataset's period files and stack them per dataset."""
    headers = headers or {}
    required_text = required_text or {}
    out = {}
    for name, parts in lines.items():
        parsed = [parse_lines(p, schemas[name], header=headers.get(name)) for p in parts]
        if required_text.get(name):
            parsed = [non_empty(p, required_text[name]) for p in parsed]
        out[name] = stack(*parsed)
    return out


def dataset_counts(stacked: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per stacked dataset, all datasets in one job."""
    return part_counts({k: v.select(F.lit(1).alias("_one")) for k, v in stacked.items()},
                       tag="dataset", total=None)


STATE = "station_state"


def load_trip_period(table: PeriodTable, period: str, files: str | Sequence[str], again: bool = False) -> PeriodLoad:
    """P1 for one period: rows, rejects and manifest replaced, then the period's station sums.

    Only this period's files and rows are read. The sums are written before the manifest would let a later
    run pass the period over, so a run that was cut off is made good by the next.
    """
    def sums(rows: DataFrame) -> None:
        trips = feat.with_day_of_week(rows, "start_date")
        state.save_state(state.group_state(trips), f"{table.root}/{STATE}", period)

    return table.load(period, [files] if isinstance(files, str) else list(files), again=again, derive=sums)


def trips_with_state(table: PeriodTable) -> DataFrame:
    """All loaded trips with the station features of the merged sums."""
    merged = state.merged_state(table.spark, f"{table.root}/{STATE}")
    return state.with_state_features(table.rows(), merged)


ALL_MODELS = ("random_forest", "decision_tree", "logistic_regression")
KEY = "trip_id"
ROWS_PER_PART = 50_000


def split_points(points: DataFrame, seed: int, split: str = "hash", key: str = KEY) -> list[DataFrame]:
    """Train and validation parts: by an md5 bucket of ``key`` or a seeded draw per key; both are the
    same on any partitioning."""
    if split == "hash":
        return [part.drop(key) for part in encode.split_by_hash(points, key)]
    if split == "random":
        return [part.drop(key) for part in encode.split_random(points, (0.8, 0.2), seed, key)]
    raise ValueError(f"unknown split {split!r}")


def dealt_by_key(points: DataFrame, key: str = KEY, rows: int = ROWS_PER_PART) -> DataFrame:
    """``points`` in partitions that depend on the rows alone: as many as ``rows`` fit in, dealt and
    ordered by ``key``. A forest draws its samples per partition, so its trees, too, are then the same
    on any cluster. Counts the rows in one job."""
    return points.repartition(max(8, -(-points.count() // rows)), key).sortWithinPartitions(key)


def train_and_measure(points: DataFrame, models: Sequence[str], seed: int, split: str = "hash",
                      key: str = KEY, indicators: bool = False) -> DataFrame:
    """Fit each model on the train part of ``points`` (features, label, key), score the validation part.

    Runs the jobs: the points are written first, the two parts are kept in
    executor memory for the iterations, and both are given up again once the
    figures, a few rows, are written. ``indicators`` says that the vectors are
    one-hot: a single tree is then grown over their entries, and without a
    forest, which draws by partition, the parts are read from the files.
    """
    points = cut_lineage(points, "points")
    if indicators and "random_forest" not in models:
        train, valid = split_points(points, seed, split, key)
    else:
        train, valid = (keep(part) for part in split_points(dealt_by_key(points, key), seed, split, key))
    makers = {
        "random_forest": lambda: learn.random_forest(seed),
        "decision_tree": lambda: learn.decision_tree(seed),
        "logistic_regression": learn.logistic_regression,
    }
    frames = []
    for m in models:
        if indicators and m == "decision_tree":
            scored = indicator_tree.fit_and_score(train, valid, learn.TREE_MAX_DEPTH)
        else:
            scored = learn.fit_and_score(makers[m](), train, valid)
        frames.append(learn.accuracy_frame(scored).select(
            F.lit(m).alias("model"), "n", "accuracy", "test_error"))
    result = cut_lineage(stack(*frames), "accuracy")
    train.unpersist()
    valid.unpersist()
    drop_files(points)
    return result.select("model", "accuracy", "test_error", "n")


def _numeric_points(d: DataFrame, key: str) -> DataFrame:
    """The baseline vector. Of the four indexed columns only the label is read; the others are checked
    for NULL, which the indexer refuses, and joined to no labels."""
    d = encode.require_values(d, [c for c in BASELINE_INDEXED if c != LABEL_SOURCE])
    d = encode.index_columns(d.select(key, LABEL_SOURCE, *BASELINE_INPUTS), [LABEL_SOURCE])
    return encode.labelled_points(encode.assemble(d, BASELINE_INPUTS), LABEL_SOURCE, key=key)


def baseline_job(trips: DataFrame, seed: int = 42, models: Sequence[str] = ALL_MODELS,
                 split: str = "hash", key: str = KEY) -> DataFrame:
    """Duration in days, four indexed columns, two numeric features.

    ``split='hash'`` splits by an md5 bucket of ``key``, ``'random'`` by a
    seeded draw per key (80/20). Jobs run here.
    """
    return train_and_measure(baseline_points(trips, key), models, seed, split, key)


def window_features(trips: DataFrame) -> DataFrame:
    """P5 features: W1 and F8."""
    return feat.with_equal_flag(feat.with_group_average(trips, "start_station", "duration"),
                                "start_station", "end_station")


def window_features_job(trips: DataFrame, seed: int = 42, models: Sequence[str] = ALL_MODELS,
                        split: str = "hash", key: str = KEY, table_name: str | None = None,
                        table_path: str | None = None) -> DataFrame:
    """P5: the window-feature variant; same two vector inputs.

    The job's features, the station average and the round-trip flag, are read by no model. With
    ``table_name`` all trips with both are written as a table, so that the job's work is whole; without,
    only what the models read is computed. Jobs run here.
    """
    if table_name:
        save_table(window_features(trips), table_name, path=table_path)
        trips = read_table(trips.sparkSession, table_name)
    return train_and_measure(_numeric_points(trips, key), models, seed, split, key)


def all_features(trips: DataFrame, table_name: str | None = None, table_path: str | None = None) -> DataFrame:
    """P6 features: W1, F8, F9-F11 and the station shares.

    Without ``table_name`` the average and the shares come from one
    aggregate and one join (``features.trip_features``). With it, the
    day-of-week step is written as a table and the shares are computed from
    that table, as the original job does.
    """
    if not table_name:
        return feat.trip_features(trips)
    d = feat.with_group_average(trips, "start_station", "duration")
    d = feat.with_equal_flag(d, "start_station", "end_station")
    d = feat.with_day_of_week(d, "start_date")
    save_table(d, table_name, path=table_path)
    return feat.with_group_shares(read_table(d.sparkSession, table_name))


def all_features_points(trips: DataFrame, table_name: str | None = None, table_path: str | None = None,
                        key: str = KEY, fit_on: str = "all", train_percent: int = 80) -> DataFrame:
    """P6 encoding: index nine columns, one-hot eight, assemble, label.

    The features are written before they are indexed, as indexing reads them
    twice. ``fit_on='train'`` fits the labels on the train part of the hash
    split alone; values that only others have get an index of their own.
    """
    d = all_features(trips, table_name, table_path)
    d = cut_lineage(d.select(key, *ALL_INDEXED), "features")
    if fit_on == "train":
        part, _ = encode.split_by_hash(d, key, train_percent)
        d = encode.index_columns(d, ALL_INDEXED, handle_invalid="keep", labels=encode.frequency_labels(part, ALL_INDEXED))
    else:
        d = encode.index_columns(d, ALL_INDEXED)
    d = encode.one_hot(d, ALL_INPUTS)
    return encode.labelled_points(encode.assemble(d, ALL_INPUTS), LABEL_SOURCE, key=key)


def all_features_job(trip_parts: Sequence[DataFrame], seed: int = 42, table_name: str | None = None,
                     table_path: str | None = None, models: Sequence[str] = ("logistic_regression",),
                     split: str = "hash", key: str = KEY, fit_on: str = "all") -> DataFrame:
    """Drop incomplete trips per part, stack, features, encode, fit, measure."""
    trips = stack(*[non_empty(p, TRIP_REQUIRED_TEXT) for p in trip_parts])
    points = all_features_points(trips, table_name, table_path, key, fit_on)
    return train_and_measure(points, models, seed, split, key, indicators=True)


def station_points(trips: DataFrame, key: str = KEY) -> DataFrame:
    """One-hot start station and the label: a small vector for a learner without penalty."""
    d = encode.index_columns(trips.select(key, "start_station", LABEL_SOURCE), ["start_station", LABEL_SOURCE])
    d = encode.one_hot(d, ["start_station"])
    return encode.labelled_points(encode.assemble(d, ["start_station"]), LABEL_SOURCE, key=key)


def scored_trips(points: DataFrame, estimator, key: str = KEY) -> DataFrame:
    """M9: the validation part with rawPrediction, probability and prediction beside ``key``."""
    points = cut_lineage(points, "points")
    train, valid = encode.split_by_hash(points, key)
    return learn.fit_and_score(estimator, train.drop(key), valid)


def rule_mismatches(points: DataFrame, estimator, key: str = KEY) -> DataFrame:
    """One row: validation rows, and those for which a fitted tree's or forest's rule table and the model
    itself differ."""
    points = cut_lineage(points, "points")
    train, valid = encode.split_by_hash(dealt_by_key(points, key), key)
    model = estimator.fit(train.drop(key))
    by_model = model.transform(valid).select(key, F.col("prediction").alias("own"))
    by_rules = rules.score_by_model_rules(valid, model, key)
    found = by_model.join(by_rules, key, "left").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("own").eqNullSafe(F.col("prediction"))).alias("mismatches"))
    result = cut_lineage(found, "mismatches")
    drop_files(points)
    return result


def penalised_fit_report(points: DataFrame, estimator=None, key: str = KEY) -> DataFrame:
    """One row about a logistic regression of the train part (the jobs' settings unless given): its rows,
    non-zero coefficients, and whether it meets the conditions of the penalised optimum."""
    points = cut_lineage(points, "points")
    train, _ = encode.split_by_hash(points, key)
    model, kept = learn.fit_logistic(estimator or learn.logistic_regression(), train)
    report = optimality.penalty_report(train, model, kept=kept).withColumn("n", F.lit(train.count()).cast("bigint"))
    result = cut_lineage(report, "optimality")
    drop_files(points)
    return result


def baseline_points(trips: DataFrame, key: str = KEY) -> DataFrame:
    """P4's points: duration in days and the start terminal."""
    d = trips.withColumns({"start_date": F.to_date("start_date"), "end_date": F.to_date("end_date")})
    return _numeric_points(feat.with_days_between(d, "end_date", "start_date", "duration"), key)
