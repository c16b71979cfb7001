"""A gradient-boosted matcher over pair features: training, prediction, and storage."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = ["name_similarity", "address_similarity", "name_is_missing", "address_is_missing", "country_match", "combined_score"]


def split_records(rows: DataFrame, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Training and calibration rows; all rows of a record are on one side, chosen by its hash."""
    part = F.pmod(F.xxhash64("source1_entity_id"), F.lit(1000)) < int(share * 1000)
    return rows.where(part), rows.where(~part)


def train(rows: DataFrame, features: list[str] | None = None, rounds: int = 50, rate: float = 0.1, depth: int = 5, seed: int = 7) -> PipelineModel:
    """rows: features and label 0 or 1."""
    features = features or FEATURES
    rows = rows.withColumn("label", F.col("label").cast("double"))
    gbt = GBTClassifier(maxIter=rounds, stepSize=rate, maxDepth=depth, subsamplingRate=0.8, featureSubsetStrategy="all", seed=seed, featuresCol="features", labelCol="label")
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), gbt]).fit(rows)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """source1_entity_id, candidate_id, proba."""
    return model.transform(rows).select("source1_entity_id", "candidate_id", vector_to_array("probability")[1].alias("proba"))


def save(model: PipelineModel, path: str, features: list[str], threshold: float) -> None:
    """The model, and beside it a row with its features and threshold, by Spark's writers so any store will do."""
    from pyspark.sql import SparkSession

    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(features), threshold)], "features string, threshold double").write.mode("overwrite").json(f"{path}/meta")


def load(path: str) -> tuple[PipelineModel, list[str], float]:
    from pyspark.sql import SparkSession

    meta = SparkSession.getActiveSession().read.schema("features string, threshold double").json(f"{path}/meta").first()
    return PipelineModel.load(f"{path}/model"), json.loads(meta["features"]) if meta["features"] else FEATURES, meta["threshold"]
