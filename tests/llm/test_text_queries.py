"""The registered queries of the subpackage and the pipeline on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from hazemart.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_bag_minhash": {"doc_id", "class_id", "kept"},
    "op2_line_spread": {"doc_id", "n_lines", "n_removed", "text_md5"},
    "op3_vector_links": {"vec_id", "n_links", "component_id", "kept"},
    "op4_piece_sampling": {"doc_id", "sample", "n_tokens", "log_prob", "log_inclusion", "ids", "ids_digest", "restored"},
    "op5_language_crf": {"doc_id", "held_out", "lang_pred", "score"},
    "op6_decontaminate": {"doc_id", "item_id", "first_word", "score", "question_overlap", "answer_overlap"},
    "op7_bilinear_lm": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op8_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op9_surrogates": {"doc_id", "n_entities", "text_md5", "spans", "n_collisions", "text"},
    "op10_quality_rules": {"doc_id", "held_out", "score", "predicted"},
    "op11_ranked_search": {"item_id", "rank", "doc_id", "score"},
    "op12_prefix_trie": {"conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"},
    "op13_page_wrappers": {"page_id", "url", "text", "n_chars"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    found = driver.queries()[name](spark, FOLDER)
    assert set(found.columns) == COLUMNS[name]
    assert found.count() > 0


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS) and set(driver.queries()) >= {*QUERIES, "pipeline"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "embeddings", "pages", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    answer = connection.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    found = QUERIES[name](spark, FOLDER).select(*columns)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(answer.fetchall(), key=str)


def test_pipeline_stages(spark, tmp_path):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select(*columns)
    known = {r.doc_id for r in docs.collect()}
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", None, None, 0), (-2, "12 34", "en", "s", 5), (None, "the and of that with from", "en", "s", 25)], docs.schema)
    docs = docs.union(odd)
    sizes = [docs.count()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        ids = {r.doc_id for r in docs.collect()} - {None}
        assert ids <= known
        sizes.append(docs.count())
        if number == 0:
            assert sizes[0] - sizes[1] == 3
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.6 * sizes[0]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert pieces.where("NOT restored").count() == 0
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).where("NOT restored").count() == 0
