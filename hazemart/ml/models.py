"""Regression of the AQI and classification of the peak flag.

Only fitted models, metric values and importances reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from hazemart import config
from hazemart.config import ModelSettings
from hazemart.ml import clusters as clustering
from hazemart.ml import metrics as measures
from hazemart.ml.preprocess import as_doubles, in_training_share, row_key, supervised_stages, unknown_columns
from hazemart.session import settled

TEXT_PREFIX = "text_tfidf_"


@dataclass
class TaskResult:
    task: str
    models: dict[str, PipelineModel]
    metrics: list[tuple[str, str, str, float]] = field(default_factory=list)


def _estimators(task: str, s: ModelSettings) -> dict:
    forest = dict(featuresCol="features", labelCol="label", numTrees=s.trees, maxDepth=s.depth, seed=s.seed)
    if task == "regression":
        return {
            "linear_regression": LinearRegression(featuresCol="features", labelCol="label"),
            "random_forest": RandomForestRegressor(**forest),
        }
    return {
        "logistic_regression": LogisticRegression(
            featuresCol="features", labelCol="label", maxIter=s.logistic_iterations
        ),
        "random_forest": RandomForestClassifier(**forest),
    }


def _evaluators(task: str) -> dict:
    if task == "regression":
        return {name: RegressionEvaluator(labelCol="label", metricName=name) for name in ("rmse", "mae", "r2")}
    return {
        "areaUnderROC": BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC"),
        **{name: MulticlassClassificationEvaluator(labelCol="label", metricName=name) for name in ("accuracy", "f1")},
    }


def labelled(features: DataFrame, label: str, settings: ModelSettings) -> DataFrame:
    """Rows that have the label, with double features and their ``split``."""
    train = in_training_share(row_key("site_id", "timestamp"), settings.train_percent)
    return (
        as_doubles(features.where(F.col(label).isNotNull()), settings.features)
        .withColumn("label", F.col(label).cast("double"))
        .withColumn("split", F.when(train, "train").otherwise("test"))
    )


def fit_task(task: str, data: DataFrame, settings: ModelSettings) -> TaskResult:
    """Fit every model of the task on the training rows, measure it on the others."""
    train = data.where("split = 'train'")
    test = data.where("split = 'test'")
    # imputer, text weights and assembler are the same for every model: fitted and applied once
    prepare = Pipeline(stages=supervised_stages(settings, unknown=unknown_columns(train, settings.features))).fit(train)
    train_vectors = prepare.transform(train).select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    test_vectors = prepare.transform(test).select("features", "label")
    result = TaskResult(task, {})
    try:
        for name, estimator in _estimators(task, settings).items():
            model = estimator.fit(train_vectors)
            scored = model.transform(test_vectors).persist(StorageLevel.MEMORY_AND_DISK)
            for metric, evaluator in _evaluators(task).items():
                result.metrics.append((task, name, metric, float(evaluator.evaluate(scored))))
            scored.unpersist()
            result.models[name] = PipelineModel([*prepare.stages, model])
    finally:
        train_vectors.unpersist()
    return result


def peak_probability(probability: str = "probability") -> Column:
    return vector_to_array(F.col(probability))[1]


def score_regression(model: PipelineModel, data: DataFrame, name: str) -> DataFrame:
    """Every row scored; ``split`` tells the rows the model was fitted on."""
    return model.transform(data).withColumns(measures.regression_scores()).select(
        "site_id", "timestamp", "date", F.col("hour").cast("int").alias("hour"), F.lit(name).alias("model"),
        "actual_aqi", "predicted_aqi", "abs_error", "split",
    )


def score_classification(model: PipelineModel, data: DataFrame, name: str) -> DataFrame:
    return model.transform(data).select(
        "site_id", "timestamp", "date", F.col("hour").cast("int").alias("hour"), F.lit(name).alias("model"),
        F.col("label").cast("int").alias("actual_peak"),
        F.col("prediction").cast("int").alias("predicted_peak"),
        F.round(peak_probability(), 4).alias("peak_probability"), "split",
    )


def forest_importance(spark: SparkSession, task: str, model: PipelineModel, settings: ModelSettings) -> DataFrame:
    """Importances of the forest, its text dimensions summed into one row."""
    names = [*settings.features, *[f"{TEXT_PREFIX}{i}" for i in range(settings.text_dims)]]
    values = model.stages[-1].featureImportances.toArray()
    rows = [(task, "random_forest", n, float(v)) for n, v in zip(names, values)]
    table = spark.createDataFrame(rows, "task string, model string, feature string, importance double")
    rolled = measures.rolled_importance(table, TEXT_PREFIX, config.TEXT_IMPORTANCE_NAME)
    return rolled.withColumn("importance", F.round("importance", 4))


def train_all(features: DataFrame, settings: ModelSettings = ModelSettings()) -> dict[str, DataFrame]:
    """All model tables by serving name. ``features`` is computed once and read by every fit."""
    spark = features.sparkSession
    features = settled(features, "features")
    regression_data = labelled(features, "aqi", settings)
    peak_data = labelled(features, "is_pollution_peak", settings)
    regression = fit_task("regression", regression_data, settings)
    classification = fit_task("classification", peak_data, settings)
    cluster_model = clustering.fit_clusters(features, settings)
    clustered = clustering.assign_clusters(cluster_model, features, settings)
    measured = [
        *regression.metrics,
        *classification.metrics,
        ("clustering", "kmeans", "silhouette", float(clustering.silhouette(clustered))),
        ("clustering", "kmeans", "k", float(settings.clusters)),
    ]
    metric_table = spark.createDataFrame(measured, "task string, model string, metric string, value double")
    return {
        "ml_regression_predictions": score_regression(
            regression.models["random_forest"], regression_data, "random_forest"
        ),
        "ml_classification_predictions": score_classification(
            classification.models["random_forest"], peak_data, "random_forest"
        ),
        "ml_metrics": metric_table.withColumn("value", F.round("value", 4)),
        "ml_feature_importance": forest_importance(
            spark, "regression", regression.models["random_forest"], settings
        ).unionByName(
            forest_importance(spark, "classification", classification.models["random_forest"], settings)
        ),
        "ml_clusters": clustering.cluster_points(clustered),
        "ml_cluster_profile": clustering.cluster_profile(clustered),
    }
