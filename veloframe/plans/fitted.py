"""A fitted trip classifier that is stored: station sums, labels, model and settings.

``fit_trips`` learns all three parts from one set of trips; ``save`` writes them below a folder (the sums
and labels as Parquet tables, the model in its ML persistence form, the settings as a line of JSON);
``load_fitted`` reads them in any session. ``score`` then needs the new trips alone: station features come
from the stored sums, categories from the stored labels, and a category that the labels lack gets the index
past the last, which has a coefficient of its own.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.operators import encode, learn, state
from veloframe.operators import features as feat
from veloframe.plans.jobs import ALL_INPUTS, KEY, LABEL_SOURCE
from veloframe.sources.catalog import cut_lineage, drop_files

STATION = "start_station"


@dataclass(frozen=True)
class FittedTrips:
    """What scoring a trip takes."""

    sums: DataFrame
    labels: DataFrame
    model: LogisticRegressionModel
    inputs: tuple[str, ...]
    label: str
    #: The features that the model is of; None: all.
    kept: tuple[int, ...] | None = None

    def features(self, trips: DataFrame, key: str = KEY, keep: tuple[str, ...] = ()) -> DataFrame:
        """(key, kept columns, features) of trips, encoded by the stored sums and labels."""
        d = feat.with_day_of_week(feat.with_equal_flag(trips, STATION, "end_station"), "start_date")
        d = state.with_state_features(d, self.sums, STATION)
        d = encode.index_columns(d.select(key, *keep, *self.inputs), list(self.inputs), "keep", self.labels)
        d = encode.one_hot(d, list(self.inputs))
        return encode.assemble(d, list(self.inputs)).select(key, *keep, "features")

    def score(self, trips: DataFrame, key: str = KEY) -> DataFrame:
        """(key, prediction, probability, predicted): the class's number, its probability vector and text."""
        scored = learn.scored_by(self.model, self.kept, self.features(trips, key))
        texts = self.labels.where(F.col("col") == self.label).select(
            F.col("idx").cast("double").alias("__idx"), F.col("value").alias("predicted"))
        return scored.join(F.broadcast(texts), F.col("prediction") == F.col("__idx"), "left").select(
            key, "prediction", "probability", "predicted")

    def save(self, path: str, overwrite: bool = False) -> None:
        """Write all parts below ``path``; the settings last, so a folder with settings is whole."""
        mode = "overwrite" if overwrite else "errorifexists"
        self.sums.write.mode(mode).parquet(f"{path}/sums")
        self.labels.write.mode(mode).partitionBy("col").parquet(f"{path}/labels")
        writer = self.model.write()
        (writer.overwrite() if overwrite else writer).save(f"{path}/model")
        settings = json.dumps({"inputs": list(self.inputs), "label": self.label, "kept": self.kept})
        self.sums.sparkSession.createDataFrame([(settings,)], "value string").coalesce(1).write.mode(mode).text(
            f"{path}/settings")


def load_fitted(spark: SparkSession, path: str) -> FittedTrips:
    """Read what ``FittedTrips.save`` wrote."""
    settings = json.loads(spark.read.text(f"{path}/settings").first()[0])
    labels = spark.read.schema("value string, n long, idx long, col string").parquet(f"{path}/labels")
    kept = settings.get("kept")
    return FittedTrips(
        spark.read.schema(state.state_schema(STATION)).parquet(f"{path}/sums"),
        labels.select("col", "value", "n", "idx"),
        LogisticRegressionModel.read().session(spark).load(f"{path}/model"), tuple(settings["inputs"]), settings["label"],
        None if kept is None else tuple(kept))


def fit_trips(trips: DataFrame, estimator=None, inputs: tuple[str, ...] = tuple(ALL_INPUTS), label: str = LABEL_SOURCE,
              key: str = KEY) -> FittedTrips:
    """Station sums, labels and a logistic regression (the jobs' settings unless given) of ``trips``.

    Jobs run here; the encoded rows are written once and removed after the fit.
    """
    d = feat.with_day_of_week(feat.with_equal_flag(trips, STATION, "end_station"), "start_date")
    sums = cut_lineage(state.group_state(d), "sums")
    d = cut_lineage(state.with_state_features(d, sums, STATION).select(key, label, *inputs), "features")
    labels = encode.frequency_labels(d, [label, *inputs])
    d = encode.index_columns(d, [label], labels=labels)
    d = encode.index_columns(d, list(inputs), "keep", labels)
    points = cut_lineage(encode.labelled_points(encode.assemble(encode.one_hot(d, list(inputs)), list(inputs)), label), "points")
    model, kept = learn.fit_logistic(estimator or learn.logistic_regression(), points)
    drop_files(points)
    return FittedTrips(sums, labels, model, inputs, label, None if kept is None else tuple(kept))
