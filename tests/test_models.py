"""Preparation, metrics and the whole training run."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from hazemart.config import TEXT_IMPORTANCE_NAME, ModelSettings
from hazemart.ml import clusters, metrics, models, preprocess
from hazemart.plans.serving import SERVING_SCHEMAS

DRAW = random.Random(3)


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(1000)
    picks = [
        {r.id for r in df.repartition(n).where(preprocess.in_training_share(F.col("id"))).collect()} for n in (1, 4, 9)
    ]
    assert picks[0] == picks[1] == picks[2]
    assert 780 <= len(picks[0]) <= 820
    huge = spark.createDataFrame([(2**62,), (-5,)], "id long")
    assert huge.where(preprocess.in_training_share(F.col("id")).isNotNull()).count() == 2


def test_impute_mean(spark):
    df = spark.createDataFrame([(1, 1.0), (None, float("nan")), (4, None)], "i int, d double")
    found = preprocess.impute_mean(df, ["i", "d"]).select("i_imp", "d_imp").collect()
    assert sorted(tuple(r) for r in found) == [(1.0, 1.0), (2.5, 1.0), (4.0, 1.0)]


def test_empty_column_is_named(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    with pytest.raises(ValueError, match=": b"):
        preprocess.require_known_values(df, ["a", "b"])


def test_column_without_values_has_no_influence(spark):
    """Its rows are scored as if the column were not there, also where a later row has a value."""
    data = [(float(i), None, float(i % 5), None if i % 9 == 0 else i * 2.0) for i in range(60)]
    table = spark.createDataFrame(data, "a double, b double, c double, label double")
    with pytest.warns(UserWarning, match=": b"):
        stages = preprocess.imputing_stages(["a", "b", "c"], "_x", preprocess.unknown_columns(table, ["a", "b", "c"]))
    later = table.withColumn("b", F.lit(7.0))
    filled = Pipeline(stages=stages).fit(table).transform(later)
    assert {tuple(r) for r in filled.select("a_x", "b_x", "c_x").collect()} == {(r[0], 0.0, r[2]) for r in data}
    with pytest.warns(UserWarning, match=": b"):
        (only,) = preprocess.imputing_stages(["b"], "_x", ["b"])
    assert {r.b_x for r in only.transform(table).collect()} == {0.0}


def test_models_without_any_value_of_a_feature(spark):
    """Classes, regressions and clusters of readings whose humidity is never known."""
    at = F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2026-04-01").cast("timestamp"))
    nothing = F.lit(None).cast("double")
    features = spark.range(240).select(
        F.lit(1).alias("site_id"), at.alias("timestamp"), F.to_date(at).alias("date"), F.hour(at).alias("hour"), F.month(at).alias("month"),
        (F.col("id") % 24 * 10).cast("double").alias("aqi"), F.col("id").cast("double").alias("pm25"), F.col("id").cast("double").alias("pm10"),
        F.when(F.col("id") % 24 > 11, 1).otherwise(0).alias("is_pollution_peak"), nothing.alias("weather_humidity"),
        *[(F.col("id") % n).cast("double").alias(c) for n, c in enumerate(("weather_temperature", "precipitation", "snowfall", "surface_pressure", "wind_speed", "wind_direction"), 2)],
        F.lit(0).alias("nmu_severity"), F.lit(0).alias("is_nmu"), F.lit("").alias("announcement_text"),
    )
    settings = ModelSettings(trees=3, depth=3, logistic_iterations=5)
    for task, label in (("regression", "aqi"), ("classification", "is_pollution_peak")):
        result = models.fit_task(task, models.labelled(features, label, settings), settings)
        forest = result.models["random_forest"].stages[-1]
        assert forest.numFeatures == len(settings.features) + settings.text_dims
        assert forest.featureImportances[settings.features.index("weather_humidity")] == 0.0
        assert result.models["random_forest"].transform(features).where("prediction IS NOT NULL").count() == 240
    clustered = clusters.assign_clusters(clusters.fit_clusters(features, settings), features, settings)
    assert clusters.cluster_points(clustered).count() == 240
    profile = clusters.cluster_profile(clustered).collect()
    assert sum(r.rows_count for r in profile) == 240 and {r.avg_weather_humidity for r in profile} == {None}


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "a double, b double")
    found = preprocess.standardize(df, ["a", "b"]).orderBy("a").collect()
    values = np.array([1.0, 2.0, 6.0])
    assert [r.a_std for r in found] == pytest.approx(list((values - values.mean()) / values.std(ddof=1)))
    assert [r.b_std for r in found] == [0.0, 0.0, 0.0]


@pytest.mark.parametrize("text", ["", "A  b", " a b  ", "  ", "x\ty\n"])
def test_tokens_equal_spark_ml(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    expected = Tokenizer(inputCol="t", outputCol="w").transform(df).first().w
    assert df.select(preprocess.tokens(F.col("t"))).first()[0] == expected


def test_text_weights(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "a"), (3, "")], "id int, t string")
    found = {(r.id, r.term): (r.tf, r.df, r.tfidf) for r in preprocess.tfidf(df, "id", "t").collect()}
    assert found[1, "a"] == (2, 2, pytest.approx(2 * np.log(4 / 3)))
    assert found[1, "b"] == (1, 1, pytest.approx(np.log(2)))
    assert found[3, ""][:2] == (1, 1)


def test_terms_are_cut_once_and_separators_beyond_ascii_stay(spark):
    df = spark.createDataFrame([(1, "A b \u2028"), (2, "a\t\x0b\r\n"), (3, " "), (4, None), (5, "")], "id int, t string")
    expected = [r.w for r in Tokenizer(inputCol="t", outputCol="w").transform(df.where("t IS NOT NULL")).orderBy("id").collect()]
    assert [r.w for r in df.where("t IS NOT NULL").orderBy("id").select(preprocess.tokens(F.col("t")).alias("w")).collect()] == expected
    found = preprocess.tfidf(df, "id", "t")
    assert {(r.id, r.term, r.tf, r.df) for r in found.collect()} == {(1, "a", 1, 2), (1, "b", 1, 1), (1, "\u2028", 1, 1), (2, "a", 1, 2), (5, "", 1, 1)}
    for weights in (found, preprocess.tfidf_hashed(df, "id", "t", 8)):
        plan = weights._jdf.queryExecution().executedPlan().toString()
        conditions = [x for x in plan.splitlines() if "Filter" in x]
        # the filter an inner explode infers would cut every text twice
        assert conditions and not [x for x in conditions if "split(" in x]
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def scored(spark):
    data = []
    for _ in range(600):
        y = DRAW.random() < 0.3
        # a third of all rows share one score
        score = 0.5 if DRAW.random() < 0.33 else round(DRAW.random() * 0.7 + 0.3 * y, 2)
        data.append((float(y), score, float(score > 0.5), DRAW.gauss(0, 1)))
    return spark.createDataFrame(data, "label double, score double, prediction double, noise double")


def test_auc_equals_spark_ml(scored):
    expected = BinaryClassificationEvaluator(rawPredictionCol="score").evaluate(scored)
    assert metrics.area_under_roc(scored, "label", "score").first()[0] == pytest.approx(expected, abs=1e-12)
    expected = BinaryClassificationEvaluator(rawPredictionCol="noise").evaluate(scored)
    assert metrics.area_under_roc(scored, "label", "noise").first()[0] == pytest.approx(expected, abs=1e-12)


def test_auc_of_one_class_is_unknown(scored):
    assert metrics.area_under_roc(scored.where("label = 1"), "label", "score").first()[0] is None


def test_classification_metrics_equal_spark_ml(scored):
    row = metrics.classification_metrics(scored, "label", "prediction").first()
    for name, value in (("accuracy", row.accuracy), ("f1", row.f1)):
        assert value == pytest.approx(MulticlassClassificationEvaluator(metricName=name).evaluate(scored), abs=1e-12)


def test_regression_metrics_equal_spark_ml(scored):
    row = metrics.regression_metrics(scored, "score", "noise").first()
    for name, value in (("rmse", row.rmse), ("mae", row.mae), ("r2", row.r2)):
        expected = RegressionEvaluator(labelCol="score", predictionCol="noise", metricName=name).evaluate(scored)
        assert value == pytest.approx(expected, abs=1e-9)


def test_best_model(spark):
    data = [("t", "b", "f1", 0.9), ("t", "a", "f1", 0.9), ("t", "c", "f1", None), ("u", "z", "f1", 0.1), ("t", "b", "auc", 1.0)]
    table = spark.createDataFrame(data, "task string, model string, metric string, value double")
    assert sorted((r.task, r.model, r.value) for r in metrics.best_models(table, "f1").collect()) == [("t", "a", 0.9), ("u", "z", 0.1)]


def test_training_run(spark):
    """All six model tables, on features where the AQI follows the wind and peaks follow the AQI."""
    rows = []
    for site in range(3):
        for i in range(200):
            wind, noticed = DRAW.random() * 10, DRAW.random() < 0.2
            aqi = 120 - 10 * wind + (30 if noticed else 0) + DRAW.random()
            rows.append((site, i, None if i % 40 == 0 else aqi, aqi / 4, aqi / 2, int(aqi > 100), wind, 2 if noticed else 0, int(noticed)))
    base = spark.createDataFrame(
        rows, "site_id int, i int, aqi double, pm25 double, pm10 double, is_pollution_peak int, wind_speed double, nmu_severity int, is_nmu int"
    )
    at = F.timestamp_add("HOUR", F.col("i"), F.lit("2026-04-01").cast("timestamp"))
    features = base.withColumns(
        {
            "timestamp": at, "date": F.to_date(at), "hour": F.hour(at), "month": F.month(at),
            "announcement_text": F.when(F.col("is_nmu") == 1, "ожидаются неблагоприятные условия").otherwise(""),
            **{c: (F.col("i") % 7).cast("double") for c in ("weather_temperature", "weather_humidity", "precipitation", "snowfall", "surface_pressure", "wind_direction")},
        }
    ).drop("i")
    settings = ModelSettings(trees=10, depth=4)
    tables = models.train_all(features, settings)
    assert tables["ml_regression_predictions"].count() == 585
    assert tables["ml_classification_predictions"].count() == 600
    assert {r["count"] > 60 for r in tables["ml_regression_predictions"].groupBy("split").count().collect()} == {True}
    values = {(r.task, r.model, r.metric): r.value for r in tables["ml_metrics"].collect()}
    assert len(values) == 14
    assert values["regression", "linear_regression", "r2"] > 0.95
    assert values["classification", "random_forest", "areaUnderROC"] > 0.9
    assert values["clustering", "kmeans", "k"] == 4.0
    importance = tables["ml_feature_importance"]
    assert importance.where(F.col("feature") == TEXT_IMPORTANCE_NAME).count() == 2
    assert importance.count() == 22
    for row in importance.groupBy("task").agg(F.sum("importance").alias("s")).collect():
        assert row.s == pytest.approx(1.0, abs=0.01)
    assert sum(r.rows_count for r in tables["ml_cluster_profile"].collect()) == 600
    for name, table in tables.items():
        assert set(SERVING_SCHEMAS[name].names) <= set(table.columns), name


def test_nearest_centre_over_blocks(spark):
    draw = random.Random(2)
    centres = [(g, [draw.randint(-9, 9) * 1.0 for _ in range(3)]) for g in range(400)] + [(-5, [1.0, 1.0, 1.0]), (7000, [1.0, 1.0, 1.0])]
    rows = [(k, k % 3, [draw.randint(-9, 9) * 1.0 for _ in range(3)]) for k in range(60)] + [(99, 0, [1.0, 1.0, 1.0]), (100, 1, None)]
    wanted = {
        (k, j): None if v is None else min((sum((a - b) ** 2 for a, b in zip(v, c)), g) for g, c in centres)[1] for k, j, v in rows
    }
    places = spark.createDataFrame(centres, "g int, centre array<double>")
    vectors = spark.createDataFrame(rows, "k int, j int, v array<double>")
    for block in (16, 10_000):
        found = clusters.nearest_of(vectors, ["k", "j"], "v", places, "g", "nearest", block)
        assert found.columns == ["k", "j", "nearest"] and {(r.k, r.j): r.nearest for r in found.collect()} == wanted


def test_nearest_centre_of_odd_vectors(spark):
    """As the column expression decides: NaN beyond infinity, missing components and other lengths are not compared."""
    inf, nan = float("inf"), float("nan")
    centres = [(3, [0.0, 0.0]), (1, [0.1, 0.2]), (2, [inf, 0.0]), (9, [1.0]), (4, [None, 1.0]), (5, None), (0, [nan, 5.0])]
    odd = [[0.1, 0.2], [inf, 0.0], [-inf, 0.0], [nan, 1.0], [None, 1.0], [7.0], [], None, [1e300, 0.0], [1e200, 1e200], [0.05, 0.1], [3.0, 4.0, 5.0]]
    vectors = spark.createDataFrame(list(enumerate(odd)), "k int, v array<float>")
    places = spark.createDataFrame(centres, "g int, centre array<double>")
    distances = clusters.centre_distances(F.col("v"), F.array(F.col("centre")))[0]
    pairs = vectors.crossJoin(places).withColumn("d", distances)
    expected = pairs.groupBy("k").agg(F.min(F.when(F.col("d").isNotNull(), F.struct("d", "g")))["g"].alias("n")).collect()
    for block in (2, 256):
        found = clusters.nearest_of(vectors, ["k"], "v", places, "g", "n", block)
        assert {r.k: r.n for r in found.collect()} == {r.k: r.n for r in expected}


def test_nearest_centre_compares_arrays(spark):
    """Distances are not evaluated by a column expression per vector and centre."""
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(2100)], "k int, v array<double>")
    places = spark.createDataFrame([(g, [g * 3.0, 1.0]) for g in range(700)], "g int, centre array<double>")
    found = clusters.nearest_of(vectors, ["k"], "v", places, "g", "n")
    assert {(r.k, r.n) for r in found.collect()} == {(i, min(699, (i + 1) // 3)) for i in range(2100)}
    plan = found._jdf.queryExecution().toString()
    assert "zip_with" not in plan and "MapInArrow" in plan


def test_hashed_vectors_fill_empty_buckets(spark):
    docs = spark.createDataFrame([(1, "a a b"), (2, ""), (3, "b")], "k int, text string")
    weights = preprocess.tfidf_hashed(docs, "k", "text", 8)
    found = {r.k: r.text_features for r in preprocess.hashed_vectors(weights, "k", 8).collect()}
    assert {len(v) for v in found.values()} == {8} and set(found) == {1, 2, 3}
    assert sorted(x for v in found.values() for x in v if x) == sorted(r.tfidf for r in weights.collect() if r.tfidf)
