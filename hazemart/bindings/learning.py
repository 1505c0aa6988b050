"""Preparation, metrics and models on the given tables."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from hazemart.bindings import tables as t
from hazemart.bindings.marts import features
from hazemart.bindings.registry import query
from hazemart.bindings.tables import SQL_EVENTS, with_roles
from hazemart.config import TEXT_IMPORTANCE_NAME, ModelSettings
from hazemart.ml import clusters, metrics, models, preprocess
from hazemart.session import settled


def measured(spark, sf_dir):
    return t.events(spark, sf_dir).select("event_id", "event_type", "user_id", "k", "q")


@query(
    "impute_mean",
    with_roles(SQL_EVENTS, select="""
    , g AS (SELECT event_id, CASE WHEN k <> 29 THEN q END AS pm10, CASE WHEN k >= 50 THEN CAST(k AS DOUBLE) END AS level FROM ev)
    SELECT event_id, coalesce(pm10, avg(pm10) OVER ()) AS pm10_imp, coalesce(level, avg(level) OVER ()) AS level_imp FROM g"""),
)
def _impute_mean(spark, sf_dir):
    """One column with nulls and NaNs, one whole-number column whose mean must not be truncated."""
    rows = measured(spark, sf_dir).select(
        "event_id",
        F.when((F.col("k") == 29) & (F.col("q") > 20), F.lit(float("nan"))).when(F.col("k") != 29, F.col("q")).alias("pm10"),
        F.when(F.col("k") >= 50, F.col("k")).alias("level"),
    )
    return preprocess.impute_mean(rows, ["pm10", "level"]).drop("pm10", "level")


@query(
    "standardize",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, round((q - avg(q) OVER ()) / stddev_samp(q) OVER (), 6) AS q_std,
           round((k - avg(k) OVER ()) / stddev_samp(k) OVER (), 6) AS k_std FROM ev"""),
)
def _standardize(spark, sf_dir):
    scaled = preprocess.standardize(measured(spark, sf_dir).select("event_id", "q", "k"), ["q", "k"])
    return scaled.select("event_id", *[F.round(c, 6).alias(c) for c in ("q_std", "k_std")])


@query(
    "hash_split",
    """SELECT event_id, CASE WHEN ((event_id % 2147483647) * 2654435761) % 100 < 80 THEN 'train' ELSE 'test' END AS split
       FROM events""",
)
def _hash_split(spark, sf_dir):
    in_train = preprocess.in_training_share(F.col("event_id"))
    return t.table(spark, sf_dir, "events").select("event_id", F.when(in_train, "train").otherwise("test").alias("split"))


@query(
    "linreg_simple",
    with_roles(SQL_EVENTS, select="""
    SELECT event_type, round(regr_slope(q, k), 6) AS slope, round(regr_intercept(q, k), 6) AS intercept,
           round(regr_r2(q, k), 6) AS r2 FROM ev GROUP BY event_type"""),
)
def _linreg_simple(spark, sf_dir):
    line = metrics.simple_line(measured(spark, sf_dir), "q", "k", ["event_type"])
    return line.select("event_type", *[F.round(c, 6).alias(c) for c in ("slope", "intercept", "r2")])


SQL_MODEL_ERRORS = """
, guesses AS (
  SELECT event_type AS model, q AS actual, CAST(k AS DOUBLE) AS predicted FROM ev)
, m AS (
  SELECT model, sqrt(sum((actual - predicted) * (actual - predicted)) / count(*)) AS rmse, avg(abs(actual - predicted)) AS mae,
         1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*)) AS r2
  FROM guesses GROUP BY model)
"""


def model_errors(spark, sf_dir):
    guesses = measured(spark, sf_dir).select(
        F.col("event_type").alias("model"), F.col("q").alias("actual"), F.col("k").cast("double").alias("predicted")
    )
    return metrics.regression_metrics(guesses, "actual", "predicted", ["model"])


@query(
    "metrics_regression",
    with_roles(SQL_EVENTS, SQL_MODEL_ERRORS, select="""
    SELECT model, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2 FROM m"""),
)
def _metrics_regression(spark, sf_dir):
    return model_errors(spark, sf_dir).select("model", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


@query(
    "metrics_long",
    with_roles(SQL_EVENTS, SQL_MODEL_ERRORS, select="""
    SELECT 'regression' AS task, model, 'rmse' AS metric, round(rmse, 4) AS "value" FROM m
    UNION ALL SELECT 'regression', model, 'mae', round(mae, 4) FROM m
    UNION ALL SELECT 'regression', model, 'r2', round(r2, 4) FROM m"""),
)
def _metrics_long(spark, sf_dir):
    return metrics.long_metrics(model_errors(spark, sf_dir), "regression", F.col("model"), ["rmse", "mae", "r2"])


@query(
    "model_select",
    with_roles(SQL_EVENTS, SQL_MODEL_ERRORS, select="""
    SELECT 'regression' AS task, 'rmse' AS metric, model, round(rmse, 4) AS "value" FROM m ORDER BY round(rmse, 4), model LIMIT 1"""),
)
def _model_select(spark, sf_dir):
    table = metrics.long_metrics(model_errors(spark, sf_dir), "regression", F.col("model"), ["rmse", "mae", "r2"])
    return metrics.best_models(table, "rmse", higher_is_better=False)


@query(
    "metrics_classification",
    with_roles(SQL_EVENTS, select="""
    , g AS (SELECT CASE WHEN q > 50 THEN 1 ELSE 0 END AS y, CASE WHEN k > 60 THEN 1 ELSE 0 END AS p FROM ev)
    , c AS (SELECT v.label, count(*) FILTER (WHERE y = v.label) AS support, count(*) FILTER (WHERE p = v.label) AS claimed,
                   count(*) FILTER (WHERE y = v.label AND p = v.label) AS hits
            FROM g CROSS JOIN (VALUES (0), (1)) v(label) GROUP BY v.label)
    SELECT round(sum(hits) / sum(support), 9) AS accuracy,
           round(sum(support * 2.0::DOUBLE * hits / (support + claimed)) / sum(support), 9) AS f1 FROM c"""),
)
def _metrics_classification(spark, sf_dir):
    guesses = measured(spark, sf_dir).select(
        (F.col("q") > 50).cast("int").alias("y"), (F.col("k") > 60).cast("int").alias("p")
    )
    quality = metrics.classification_metrics(guesses, "y", "p")
    return quality.select(*[F.round(c, 9).alias(c) for c in ("accuracy", "f1")])


@query(
    "metrics_auc",
    """
    WITH s AS (SELECT quality AS y, n_chars AS score FROM labels JOIN documents USING (doc_id))
    , r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM s)
    SELECT round((sum(rk) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
                 / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)), 9)::DOUBLE AS area_under_roc FROM r""",
)
def _metrics_auc(spark, sf_dir):
    scored = t.table(spark, sf_dir, "labels").select("doc_id", "quality").join(
        t.table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id"
    )
    area = metrics.area_under_roc(scored, "quality", "n_chars")
    return area.select(F.round("area_under_roc", 9).alias("area_under_roc"))


@query(
    "nearest_centroid",
    """
    WITH v AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM embeddings)
    , c AS (SELECT label AS c_label, d, avg(CAST(x AS DOUBLE)) AS m FROM v GROUP BY label, d)
    , w AS (SELECT vec_id, c_label, sum((x - m) * (x - m)) AS dist FROM v JOIN c USING (d) GROUP BY vec_id, c_label)
    SELECT vec_id, arg_min(c_label, dist) AS cluster FROM w GROUP BY vec_id""",
)
def _nearest_centroid(spark, sf_dir):
    vectors = t.table(spark, sf_dir, "embeddings")
    centres = clusters.group_centres(vectors, "label", "embedding")
    return clusters.nearest_of(vectors, ["vec_id"], "embedding", centres, "label", "cluster")


@query(
    "nearest_of_many",
    """
    WITH v AS (SELECT vec_id, label * 1000 + vec_id % 300 AS g, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM embeddings)
    , c AS (SELECT g AS centre, d, avg(CAST(x AS DOUBLE)) AS m FROM v GROUP BY g, d)
    , w AS (SELECT vec_id, centre, sum((x - m) * (x - m)) AS dist FROM v JOIN c USING (d) GROUP BY vec_id, centre)
    SELECT vec_id, first(centre ORDER BY round(dist, 9), centre) AS cluster FROM w GROUP BY vec_id""",
)
def _nearest_of_many(spark, sf_dir):
    """Thousands of centres, in blocks of 64."""
    vectors = t.table(spark, sf_dir, "embeddings").withColumn("g", F.col("label") * 1000 + F.col("vec_id") % 300)
    centres = clusters.group_centres(vectors, "g", "embedding")
    return clusters.nearest_of(vectors, ["vec_id"], "embedding", centres, "g", "cluster", block=64)


@query(
    "importance_rollup",
    with_roles(SQL_EVENTS, select=f"""
    SELECT 'regression' AS task, 'random_forest' AS model,
           CASE WHEN event_type = 'view' THEN '{TEXT_IMPORTANCE_NAME}' ELSE event_type END AS feature, sum(q) AS importance
    FROM ev GROUP BY 3"""),
)
def _importance_rollup(spark, sf_dir):
    """Values of view events stand for text dimensions, those of other events for named features."""
    text_dimension = F.concat(F.lit(models.TEXT_PREFIX), F.pmod("user_id", F.lit(64)).cast("string"))
    rows = measured(spark, sf_dir).select(
        F.lit("regression").alias("task"), F.lit("random_forest").alias("model"),
        F.when(F.col("event_type") == "view", text_dimension).otherwise(F.col("event_type")).alias("feature"),
        F.col("q").alias("importance"),
    )
    return metrics.rolled_importance(rows, models.TEXT_PREFIX, TEXT_IMPORTANCE_NAME)


@query("ml_tfidf")
def _ml_tfidf(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents").select("doc_id", "text")
    fitted = Pipeline(stages=preprocess.text_stages("text", "text_features", ModelSettings().text_dims)).fit(docs)
    return fitted.transform(docs).select("doc_id", vector_to_array("text_features").alias("text_features"))


def fitted_task(spark, sf_dir, task, label):
    settings = ModelSettings()
    data = models.labelled(settled(features(spark, sf_dir), "features"), label, settings)
    return data, models.fit_task(task, data, settings)


@query("ml_regress")
def _ml_regress(spark, sf_dir):
    data, result = fitted_task(spark, sf_dir, "regression", "aqi")
    return models.score_regression(result.models["random_forest"], data, "random_forest")


@query("ml_classify")
def _ml_classify(spark, sf_dir):
    data, result = fitted_task(spark, sf_dir, "classification", "is_pollution_peak")
    scored = [models.score_classification(model, data, name) for name, model in result.models.items()]
    return scored[0].unionByName(scored[1])


@query(
    "ml_logistic_odds",
    with_roles(SQL_EVENTS, select="""
    , p AS (SELECT event_type = 'view' AS x, q >= 30 AS y FROM ev WHERE q IS NOT NULL)
    , n AS (SELECT count(*) FILTER (WHERE NOT x AND NOT y) AS n00, count(*) FILTER (WHERE NOT x AND y) AS n01,
                   count(*) FILTER (WHERE x AND NOT y) AS n10, count(*) FILTER (WHERE x AND y) AS n11 FROM p)
    SELECT round(ln(n01 / n00), 4) AS intercept, round(ln(n11 / n10) - ln(n01 / n00), 4) AS weight, n00 + n01 + n10 + n11 AS n FROM n"""),
)
def _ml_logistic_odds(spark, sf_dir):
    """The fitted weights of one 0/1 feature without penalty are log odds."""
    points = t.events(spark, sf_dir).where("q IS NOT NULL").select(
        (F.col("event_type") == "view").cast("double").alias("view"), (F.col("q") >= 30).cast("double").alias("label")
    )
    vectors = VectorAssembler(inputCols=["view"], outputCol="x").transform(points)
    fitted = LogisticRegression(featuresCol="x", maxIter=200, tol=1e-12, regParam=0.0, standardization=False).fit(vectors)
    row = (round(float(fitted.intercept), 4), round(float(fitted.coefficients[0]), 4), points.count())
    return spark.createDataFrame([row], "intercept double, weight double, n long")


@query(
    "tfidf_hashed",
    """
    WITH words AS (
      SELECT doc_id, CASE WHEN body = '' AND text <> '' THEN [] ELSE regexp_split_to_array(body, '\\s') END AS terms
      FROM (SELECT doc_id, text, regexp_replace(lower(text), '\\s+$', '') AS body FROM documents))
    , t AS (SELECT doc_id, CAST(('0x' || left(md5(unnest(terms)), 8))::BIGINT % 64 AS INTEGER) AS bucket FROM words)
    , counts AS (SELECT doc_id, bucket, count(*) AS tf FROM t GROUP BY doc_id, bucket)
    , frequency AS (SELECT bucket, count(*) AS df FROM counts GROUP BY bucket)
    SELECT doc_id, bucket, tf, df, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 9) AS tfidf FROM counts JOIN frequency USING (bucket)""",
)
def _tfidf_hashed(spark, sf_dir):
    return preprocess.tfidf_hashed(t.table(spark, sf_dir, "documents"), "doc_id", "text").withColumn("tfidf", F.round("tfidf", 9))


@query(
    "ml_kmeans_points",
    with_roles(SQL_EVENTS, select="""
    SELECT event_id, CAST(event_id % 3 AS INTEGER) AS cluster, round(q, 2) AS q FROM ev WHERE k IS NOT NULL AND q IS NOT NULL"""),
)
def _ml_kmeans_points(spark, sf_dir):
    """The point table of three groups that lie far apart: every point is in the cluster of its group, numbered by their centres."""
    points = t.events(spark, sf_dir).where("k IS NOT NULL AND q IS NOT NULL").select(
        "event_id", (F.col("k") + 1000000 * F.pmod("event_id", F.lit(3))).cast("double").alias("k"), "q"
    )
    vectors = VectorAssembler(inputCols=["k", "q"], outputCol="x").transform(points)
    fitted = KMeans(featuresCol="x", predictionCol="found", k=3, seed=7, initSteps=5).fit(vectors)
    order = sorted(range(3), key=lambda i: fitted.clusterCenters()[i][0])
    number = F.element_at(F.array(*[F.lit(order.index(i)) for i in range(3)]), F.col("found") + 1)
    return fitted.transform(vectors).select("event_id", number.cast("int").alias("cluster"), F.round("q", 2).alias("q"))


@query("ml_kmeans")
def _ml_kmeans(spark, sf_dir):
    settings = ModelSettings()
    table = settled(features(spark, sf_dir), "features")
    return clusters.cluster_points(clusters.assign_clusters(clusters.fit_clusters(table, settings), table, settings))


@query(
    "ml_linear_fit",
    with_roles(SQL_EVENTS, select="""
    SELECT round(regr_slope(q, k), 6) AS slope, round(regr_intercept(q, k), 6) AS intercept, round(regr_r2(q, k), 6) AS r2,
           count(*) AS n FROM ev WHERE k IS NOT NULL AND q IS NOT NULL"""),
)
def _ml_linear_fit(spark, sf_dir):
    """The estimator's own coefficients, against the closed form."""
    points = t.events(spark, sf_dir).where("k IS NOT NULL AND q IS NOT NULL").select(F.col("k").cast("double").alias("k"), "q")
    vectors = VectorAssembler(inputCols=["k"], outputCol="x").transform(points)
    fitted = LinearRegression(featuresCol="x", labelCol="q", solver="normal").fit(vectors)
    row = (float(fitted.coefficients[0]), float(fitted.intercept), float(fitted.summary.r2), int(fitted.summary.numInstances))
    found = spark.createDataFrame([row], "slope double, intercept double, r2 double, n long")
    return found.withColumns({c: F.round(c, 6) for c in ("slope", "intercept", "r2")})


@query(
    "ml_kmeans_means",
    with_roles(SQL_EVENTS, select="""
    SELECT CAST(event_id % 2 AS INTEGER) AS side, round(avg(k + 100000 * (event_id % 2)), 6) AS k, round(avg(q), 6) AS q, count(*) AS n
    FROM ev WHERE k IS NOT NULL AND q IS NOT NULL GROUP BY event_id % 2"""),
)
def _ml_kmeans_means(spark, sf_dir):
    """Two groups far apart: the fitted centres are their means."""
    side = F.pmod("event_id", F.lit(2))
    points = t.events(spark, sf_dir).where("k IS NOT NULL AND q IS NOT NULL").select(
        (F.col("k") + 100000 * side).cast("double").alias("k"), "q"
    )
    fitted = KMeans(featuresCol="x", k=2, seed=1).fit(VectorAssembler(inputCols=["k", "q"], outputCol="x").transform(points))
    found = sorted(zip([[float(v) for v in c] for c in fitted.clusterCenters()], fitted.summary.clusterSizes))
    rows = [(i, round(c[0], 6), round(c[1], 6), int(n)) for i, (c, n) in enumerate(found)]
    return spark.createDataFrame(rows, "side int, k double, q double, n long")


@query(
    "ml_silhouette",
    with_roles(SQL_EVENTS, select="""
    , p AS (SELECT CAST(k AS DOUBLE) AS x, q AS y, k % 3 AS c FROM ev WHERE k IS NOT NULL AND q IS NOT NULL)
    , g AS (SELECT c, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x + y * y) AS s2 FROM p GROUP BY c)
    , d AS (SELECT p.x, p.y, p.c, g.c AS other, g.n,
                   (p.x * p.x + p.y * p.y) * g.n + g.s2 - 2 * (p.x * g.sx + p.y * g.sy) AS total FROM p, g)
    , s AS (SELECT x, y, max(CASE WHEN c = other THEN total / (n - 1) END) AS a, min(CASE WHEN c <> other THEN total / n END) AS b
            FROM d GROUP BY x, y, c)
    SELECT round(sum(((b - a) / greatest(a, b)) * w) / sum(w), 6) AS silhouette
    FROM s JOIN (SELECT x, y, count(*) AS w FROM p GROUP BY x, y) USING (x, y)"""),
)
def _ml_silhouette(spark, sf_dir):
    """Squared-distance silhouette of a fixed assignment, against its closed form."""
    points = t.events(spark, sf_dir).where("k IS NOT NULL AND q IS NOT NULL").select(
        F.col("k").cast("double").alias("k"), "q", F.pmod("k", F.lit(3)).cast("int").alias("cluster")
    )
    found = clusters.silhouette(VectorAssembler(inputCols=["k", "q"], outputCol="scaled_position").transform(points))
    return spark.createDataFrame([(round(found, 6),)], "silhouette double")


@query(
    "ml_forest_bounds",
    """
    SELECT task, true AS every_row_scored, true AS values_in_range, true AS no_worse_than_mean FROM (VALUES
    ('regression'), ('classification')) v(task)""",
)
def _ml_forest_bounds(spark, sf_dir):
    """What must hold for the fitted models on any data."""
    data, result = fitted_task(spark, sf_dir, "regression", "aqi")
    scores = models.score_regression(result.models["random_forest"], data, "random_forest").where("split = 'train'")
    train = data.where("split = 'train'").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.avg("label").alias("mean"),
                                              F.count("*").alias("n"))
    regression = scores.crossJoin(F.broadcast(train)).agg(
        (F.count("predicted_aqi") == F.max("n")).alias("every_row_scored"),
        F.bool_and(F.col("predicted_aqi").between(F.col("low") - 0.01, F.col("high") + 0.01)).alias("values_in_range"),
        (F.sum(F.pow(F.col("actual_aqi") - F.col("predicted_aqi"), 2)) <= F.sum(F.pow(F.col("actual_aqi") - F.col("mean"), 2)))
        .alias("no_worse_than_mean"),
    ).select(F.lit("regression").alias("task"), "*")
    data, result = fitted_task(spark, sf_dir, "classification", "is_pollution_peak")
    scores = models.score_classification(result.models["random_forest"], data, "random_forest")
    whole = data.agg(F.count("*").alias("n")).first()["n"]
    classification = scores.agg(
        (F.count("predicted_peak") == whole).alias("every_row_scored"),
        F.bool_and(
            F.col("peak_probability").between(0, 1)
            & ((F.abs(F.col("peak_probability") - 0.5) < 0.001) | ((F.col("peak_probability") > 0.5) == (F.col("predicted_peak") == 1)))
        ).alias("values_in_range"),
        (F.avg((F.col("actual_peak") == F.col("predicted_peak")).cast("int"))
         >= F.greatest(F.avg("actual_peak"), 1 - F.avg("actual_peak")) - 0.02).alias("no_worse_than_mean"),
    ).select(F.lit("classification").alias("task"), "*")
    return regression.union(classification)
