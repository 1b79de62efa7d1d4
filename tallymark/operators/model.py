"""Pair classifiers on Spark ML, and scoring."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .features import FEATURES


def class_counts(rows: DataFrame) -> DataFrame:
    """One row: positives, negatives, and the weight of a positive, with which both classes weigh the same."""
    out = rows.agg(F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") == 0).alias("negatives"))
    return out.withColumn("weight", F.when(F.col("positives") > 0, F.col("negatives") / F.col("positives")).otherwise(F.lit(1.0)))


def zero_filled(rows: DataFrame, columns=FEATURES) -> DataFrame:
    """The rows, with features that they lack as 0."""
    return rows.withColumns({c: F.lit(0.0) for c in columns if c not in rows.columns})


def train(rows: DataFrame, kind: str = "gbt", columns=FEATURES, iterations: int = 100, seed: int = 42, step: float = 0.05, depth: int = 6, least: int = 20, share: float = 0.8) -> PipelineModel:
    """Fit to rows with the features and label; positives weigh as much as all negatives.

    Trees: step is the learning rate, least the rows of a leaf, share that of rows and columns to a tree.
    """
    weight = class_counts(rows).first()["weight"]
    rows = rows.withColumn("weight", F.when(F.col("label") == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))
    common = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}
    if kind == "gbt":
        estimator = GBTClassifier(maxIter=iterations, stepSize=step, maxDepth=depth, minInstancesPerNode=least, subsamplingRate=share, featureSubsetStrategy=str(share), seed=seed, **common)
    elif kind == "forest":
        estimator = RandomForestClassifier(numTrees=iterations, maxDepth=depth + 2, seed=seed, **common)
    elif kind == "logistic":
        estimator = LogisticRegression(maxIter=iterations, **common)
    else:
        raise ValueError(f"unsupported model type: {kind}")
    return Pipeline(stages=[VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="keep"), estimator]).fit(rows)


def feature_names(model: PipelineModel, columns=FEATURES) -> list[str]:
    """The saved order of features; another set of columns is an error."""
    saved = model.stages[0].getInputCols()
    if set(saved) != set(columns):
        raise ValueError(f"feature columns differ: {sorted(set(saved) ^ set(columns))}")
    return saved


def predict(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """The rows with probability; features that are missing count as 0."""
    rows = zero_filled(rows, model.stages[0].getInputCols())
    scored = model.transform(rows)
    kept = [c for c in rows.columns if c != "probability"]
    return scored.select(*kept, vector_to_array("probability")[1].alias("probability"))


def importances(model: PipelineModel, n: int = 10) -> list[tuple[str, float]]:
    values = model.stages[-1].featureImportances.toArray()
    return sorted(zip(model.stages[0].getInputCols(), values.tolist()), key=lambda x: (-x[1], x[0]))[:n]


def save(model: PipelineModel, path: str, meta: dict) -> None:
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")


def linear_score(features: DataFrame) -> DataFrame:
    """A scorer without a model: a fixed combination of native features, rounded to 6 places."""
    p = 0.55 * F.col("name_jaccard") + 0.2 * F.col("postal_code_match") + 0.15 * F.col("address_jaccard") + 0.1 * F.col("country_exact")
    return features.withColumn("probability", F.round(p, 6))
