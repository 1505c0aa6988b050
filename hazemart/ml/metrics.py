"""Quality of predictions as plain aggregates, and the long metric table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazemart.operators.ordered import running_before


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and R2 in one pass. R2 compares with the spread of ``actual``."""
    error = F.col(actual) - F.col(predicted)
    squares = F.sum(error * error)
    return df.groupBy(*by).agg(
        F.sqrt(squares / F.count(F.lit(1))).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.lit(1.0) - F.try_divide(squares, F.var_pop(actual) * F.count(F.lit(1)))).alias("r2"),
    )


def classification_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Accuracy and support-weighted F1 from the confusion matrix."""
    cells = df.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("n"))
    # both views of a cell, so that one grouping gives support, claims and hits of every class
    sides = F.array(
        F.struct(F.col(actual).cast("double").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("claimed")),
        F.struct(F.col(predicted).cast("double").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("claimed")),
    )
    hit = F.when(F.col(actual).cast("double") == F.col(predicted).cast("double"), F.col("n")).otherwise(0)
    per_class = (
        cells.select(F.explode(sides).alias("s"), hit.alias("hit"))
        .groupBy("s.label")
        .agg(
            F.sum("s.support").alias("support"), F.sum("s.claimed").alias("claimed"),
            # a hit shows up on both sides of its cell
            (F.sum("hit") / 2).alias("hits"),
        )
    )
    f1 = 2 * F.col("hits") / (F.col("support") + F.col("claimed"))
    return per_class.agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        (F.sum(f1 * F.col("support")) / F.sum("support")).alias("f1"),
    )


def area_under_roc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Share of (positive, negative) pairs ranked right, ties counting half.

    Rows are first reduced to one per distinct score; the running count of negatives is taken in
    slices of the score range, so neither equal nor all-different scores end in one task.
    """
    per_score = df.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("positives"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("negatives"),
    )
    ranked = running_before(per_score, [], "score", "negatives", "negatives_below")
    won = F.sum(F.col("positives") * (F.col("negatives_below") + F.col("negatives") / 2))
    return ranked.agg(
        F.try_divide(won, F.sum("positives").cast("double") * F.sum("negatives")).alias("area_under_roc")
    )


def long_metrics(metrics: DataFrame, task: str | Column, model: str | Column, names: Sequence[str]) -> DataFrame:
    """Wide metric columns as (task, model, metric, value) rows, rounded to 4 places."""
    task = F.lit(task) if isinstance(task, str) else task
    model = F.lit(model) if isinstance(model, str) else model
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]))
    return metrics.select(task.alias("task"), model.alias("model"), pairs.alias("p")).select(
        "task", "model", "p.metric", F.round("p.value", 4).alias("value")
    )


def best_models(metrics: DataFrame, metric: str, higher_is_better: bool = True) -> DataFrame:
    """Per task the model with the best value of ``metric``; ties go to the first name."""
    value = F.col("value") if higher_is_better else -F.col("value")
    chosen = metrics.where((F.col("metric") == metric) & F.col("value").isNotNull())
    # the smallest (negated value, name) is the best value with the first name
    best = F.min(F.struct((-value).alias("v"), F.col("model"), F.col("value").alias("shown")))
    return chosen.groupBy("task", "metric").agg(best.alias("b")).select(
        "task", "metric", F.col("b.model").alias("model"), F.col("b.shown").alias("value")
    )


def rolled_importance(importance: DataFrame, prefix: str, name: str) -> DataFrame:
    """Importances with all features that start with ``prefix`` summed into ``name``."""
    rolled = F.when(F.col("feature").startswith(prefix), F.lit(name)).otherwise(F.col("feature"))
    return importance.groupBy("task", "model", rolled.alias("feature")).agg(F.sum("importance").alias("importance"))


def regression_scores(actual: str = "label", predicted: str = "prediction") -> dict[str, Column]:
    return {
        "actual_aqi": F.round(actual, 2),
        "predicted_aqi": F.round(predicted, 2),
        "abs_error": F.round(F.abs(F.col(predicted) - F.col(actual)), 2),
    }


def simple_line(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line of ``y`` on one feature, in one pass."""
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")
    )
