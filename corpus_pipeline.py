"""The training-text pipeline: languages, boilerplate lines, near duplicates, benchmark leaks, pieces.

Each stage takes (spark, docs, sf_dir) and decides for all documents its predecessor kept. A stage's
result is written to the shared folder and read again by the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemart.llm import bag_minhash, decontaminate, language_crf, line_spread, piece_sampling
from hazemart.llm.queries import table, tokenizer_path
from hazemart.session import settled

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: documents whose most likely language has a lower mean word probability are rejected
MIN_LANGUAGE_SCORE = 0.35

#: no SQL states a conditional random field or a sampler; the stages are tested against brute force
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents in no recognisable language (no letter, or no language that stands out).

    Every row is judged by its own text, repeated rows and rows without an id too.
    """
    return language_crf.recognised(docs, language_crf.fit_documents(docs), MIN_LANGUAGE_SCORE)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go; a document of which nothing but white space is left goes with them.

    Rows with one id are treated alike, rows without an id stay as they are.
    """
    cleaned = line_spread.remove_spread_lines(docs)
    touched = F.col("n_removed") > 0
    kept = cleaned.where(~touched | (F.regexp_replace("text", r"\s+", "") != ""))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(touched, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates; rows without an id stay.

    Of rows with the same id and text one stays.
    """
    classes = settled(bag_minhash.near_duplicates(docs), "classes")
    kept = docs.join(classes.where(~F.col("kept")).select("doc_id").distinct(), "doc_id", "left_anti")
    # seldom any: only those rows are compared by their texts
    repeated = classes.groupBy("doc_id").count().where("doc_id IS NOT NULL AND count > 1").select("doc_id")
    copies = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, "doc_id", "left_anti").unionByName(copies).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold question and answer of a benchmark item; rows without an id stay."""
    hits = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(hits.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document, with a flag that decoding restores the text."""
    return piece_sampling.sampled_segmentations(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("lines", without_boilerplate),
    ("near_duplicates", one_of_each),
    ("benchmark", without_benchmark),
    ("pieces", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
