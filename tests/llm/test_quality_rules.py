"""The rule ensemble on held-out labels, and its compiled column."""

import math

from pyspark.sql import functions as F

from hazemart.llm import quality_rules

FOLDER = "/root/testdata/sf0.01"


def test_held_out_quality(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = quality_rules.fit(docs, labels, ~held)
    assert 0 < len(model.rules) < 120
    rows = quality_rules.scored(docs, model).join(labels, "doc_id").where(held).select("score", "predicted", "quality").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    odd = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "x" * 100_000, 1), (None, "a", 1), (3, "x" * 100_000, 1)], "doc_id long, text string, score int")
    found = quality_rules.scored(odd, model)
    assert found.columns == ["doc_id", "score", "predicted"] and found.count() == 5
    assert found.where("score IS NULL").count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert quality_rules.scored(odd.limit(0), model).count() == 0


def test_rules_mean_what_they_say(spark):
    model = quality_rules.RuleModel(0.5, (((("upper", True, 0.5), ("log_words", False, 3.0)), -2.0), ((("digits", True, 0.1),), 1.0)))
    rows = spark.createDataFrame([(1, "AAAA BBBB"), (2, "aaaa bbbb"), (3, "1234"), (4, "AA " * 100)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality_rules.scored(rows, model).collect()}
    expected = {1: -1.5, 2: 0.5, 3: 1.5, 4: 0.5}
    assert all(abs(got[i] - 1 / (1 + math.exp(-x))) < 1e-12 for i, x in expected.items())


def test_one_class_only(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc_id long, quality int")
    assert quality_rules.fit(docs, labels).rules == ()
    assert quality_rules.fit(docs, labels.limit(0)).intercept == 0.0
