"""Token counts by prefix dynamic programming against the tokenizer library."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hazemart.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  a   b\n\n c 's 'S x've ½ ² ٣ \x85 foo_bar __ 漢字 é é <|endoftext|> a<|endoftext|><|endoftext|>  <|endoftext|>  b",
    "​  x　y  ", "don't we'll  I'D 12ab٣ ⅷ", "a\x00b\x1f c   ", "𝒳𝟙 𝒳 a𝒳b", "x" * 300, "é" * 50 + " \n\t ",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    draw = random.Random(4)
    made = ["".join(draw.choice("aeé tn's.\n 1<|>漢") for _ in range(draw.randint(1, 60))) for _ in range(200)]
    return [r.text for r in rows if r.text] + ODD + made


def test_counts_equal_the_library(texts, library):
    counter = token_counts.counter(PATH)
    assert [counter.count(t) for t in texts] == [library(t) for t in texts]


def test_every_prefix_and_budget(texts, library):
    counter = token_counts.counter(PATH)
    for text in [*ODD, *[t[:150] for t in texts[:10]]]:
        stored = counter.boundaries(text)
        counts = [library(text[:i]) for i in range(len(text) + 1)]
        assert [counter.count_at(text, i, stored) for i in range(len(text) + 1)] == counts
        for budget in (0, 1, 3, 10):
            cut = counter.longest_prefix(text, budget, stored)
            assert counts[cut] <= budget
            assert cut == len(text) or counts[cut + 1] > budget or cut in stored[0]


def test_rows(spark, library):
    data = [(1, "hello <|endoftext|> world", "x"), (1, "hello <|endoftext|> world", "x"), (2, None, "x"), (3, "", "x"), (None, "a b", "x"), (5, "word " * 2000, "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, n_tokens string")
    found = sorted(map(tuple, token_counts.token_counts(docs, PATH).collect()), key=str)
    expected = sorted([(i, len((t or "").encode()), library(t or ""), library(t or "") > 1024) for i, t, _ in data], key=str)
    assert found == expected
    assert token_counts.token_counts(docs.limit(0), PATH).count() == 0


def test_stored_prefixes(spark, library):
    docs = spark.createDataFrame([(1, "one two  three"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in token_counts.prefix_table(docs, PATH).collect()}
    assert rows[1].ends[-1] == len("one two  three") and rows[1].tokens[-1] == library("one two  three")
    assert (rows[2].ends, rows[2].tokens) == ([0], [0])
    assert docs.where(F.col("doc_id") > 9).count() == 0


def test_what_a_task_remembers_is_bounded(library, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED_PIECES", 5)
    monkeypatch.setattr(token_counts, "CACHED_PAIRS", 7)
    counter = token_counts.PrefixCounter(PATH)
    text = "several words of which most are new to the counter " + "x" * 300 + " and again several words " + "ab" * 200
    assert counter.count(text) == library(text)
    assert len(counter._totals) <= 5 and len(counter._pairs) <= 7
    assert max(map(len, counter._totals)) <= token_counts.CACHED_LENGTH
