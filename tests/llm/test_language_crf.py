"""Forward-backward against brute force; languages of held-out documents and of switched words."""

import numpy as np
from pyspark.sql import functions as F

from hazemart.llm import language_crf

FOLDER = "/root/testdata/sf0.01"


def test_marginals_against_brute_force():
    random = np.random.default_rng(0)
    lengths, k = [100, 1, 49, 33, 32, 64, 65], 3
    rows = np.repeat(np.arange(len(lengths)), lengths)
    scores, transitions, start = random.normal(size=(len(rows), k)), random.normal(size=(k, k)), random.normal(size=k)
    found, _ = language_crf.marginals(scores, rows, transitions, start)
    for r in range(len(lengths)):
        own = scores[rows == r]
        a, b = np.zeros_like(own), np.zeros_like(own)
        a[0] = start + own[0]
        for t in range(1, len(own)):
            a[t] = np.logaddexp.reduce(a[t - 1][:, None] + transitions, axis=0) + own[t]
        for t in range(len(own) - 2, -1, -1):
            b[t] = np.logaddexp.reduce(transitions + own[t + 1] + b[t + 1], axis=1)
        joint = a + b
        assert np.allclose(found[rows == r], np.exp(joint - np.logaddexp.reduce(joint, axis=1)[:, None]))


def test_held_out_accuracy_and_odd_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_crf.fit_documents(docs, ~held)
    found = language_crf.predict(docs, model).join(docs, "doc_id").where(held)
    accuracy = found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert accuracy > 0.95
    assert found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    words = language_crf.word_languages(model, "the and that with this from der und die schlichkeit einheit ung mit")
    assert words[0][1] == "en" and words[-3][1] == "de"
    odd = [(1, None, 1), (2, "", 1), (3, "12 34 !?", 1), (4, "— «»", 1), (None, "the and of that", 1), (6, "THE AND OF THAT", 1), (7, "the " * 30000, 1), (6, "THE AND OF THAT", 1)]
    frame = spark.createDataFrame(odd, "doc_id long, text string, score int")
    got = [(r.doc_id, r.lang_pred) for r in language_crf.predict(frame, model).collect()]
    assert sorted(got, key=str) == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "und"), (None, "en"), (6, "en"), (7, "en"), (6, "en")], key=str)
    assert language_crf.recognised(frame, model, 0.35).count() == 4
    assert language_crf.predict(frame.limit(0), model).count() == 0


def test_one_or_no_language(spark):
    frame = spark.createDataFrame([(1, "some words", None), (2, "other words", "en")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language_crf.predict(frame, language_crf.fit_documents(frame.where("doc_id = 1"))).collect()} == {"und"}
    assert {r.lang_pred for r in language_crf.predict(frame, language_crf.fit_documents(frame)).collect()} == {"en"}
