"""Tip model: linear regression on seven trip features, fitted, exported and applied as Spark jobs."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The features of the tip model.
CATEGORIES = ["PULocationID", "DOLocationID", "payment_type"]
NUMBERS = ["passenger_count", "trip_distance", "fare_amount", "tolls_amount"]


def fit_tip_model(trips: DataFrame, label: str = "tip_amount") -> PipelineModel:
    """Fit on all rows with a known tip.

    Codes have a bounded number of values (a few hundred zones), so the normal equations of the
    regression stay small and need a single pass.
    """
    trips = trips.select(*CATEGORIES, *NUMBERS, label).dropna()
    indexers = StringIndexer(
        inputCols=CATEGORIES, outputCols=[f"{c}_index" for c in CATEGORIES], handleInvalid="keep"
    )
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in CATEGORIES], outputCols=[f"{c}_flags" for c in CATEGORIES]
    )
    vector = VectorAssembler(
        inputCols=[*NUMBERS, *[f"{c}_flags" for c in CATEGORIES]], outputCol="features"
    )
    regression = LinearRegression(
        featuresCol="features", labelCol=label, predictionCol="predicted_tip", regParam=1e-6
    )
    return Pipeline(stages=[indexers, encoder, vector, regression]).fit(trips)


def score_tips(model: PipelineModel, trips: DataFrame) -> DataFrame:
    """Batch scoring: the input columns and `predicted_tip`."""
    return model.transform(trips).select(*trips.columns, "predicted_tip")


ABOUT = "version string, features array<string>, prediction string, spark string"


def export_tip_model(spark: SparkSession, model: PipelineModel, folder: str, version: str) -> str:
    """Write a fitted model below a folder of models, with what a reader has to know beside it; returns its path.

    A version is written once: one that is there already is an error. The note comes last, so a model without it was not finished.
    """
    path = f"{folder.rstrip('/')}/version={version}"
    model.write().session(spark).save(f"{path}/model")
    about = [(version, [*CATEGORIES, *NUMBERS], "predicted_tip", spark.version)]
    spark.createDataFrame(about, ABOUT).coalesce(1).write.json(f"{path}/about")
    return path


def load_tip_model(spark: SparkSession, folder: str, version: str | None = None) -> PipelineModel:
    """An exported model, of the given version or the last one by name. One that was fitted on other features is an error."""
    notes = spark.read.schema(ABOUT).json(f"{folder.rstrip('/')}/version=*/about")
    if version is not None:
        notes = notes.where(F.col("version") == version)
    note = notes.orderBy(F.desc("version")).first()
    if note is None:
        raise FileNotFoundError(f"no model {version or ''} in {folder}")
    if note["features"] != [*CATEGORIES, *NUMBERS]:
        raise ValueError(f"model {note['version']} takes the features {note['features']}")
    return PipelineModel.read().session(spark).load(f"{folder.rstrip('/')}/version={note['version']}/model")
