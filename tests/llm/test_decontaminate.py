"""BM25 retrieval by block-max WAND against all scores, and leaks against containment."""

import re

import numpy as np

from hazemart.llm import decontaminate

FOLDER = "/root/testdata/sf0.01"


def normal(text):
    return f" {' '.join(re.findall(r'[0-9A-Za-z_\x80-\U0010ffff]+', (text or '').lower()))} "


def test_wand_finds_all_above_the_threshold():
    random = np.random.default_rng(3)
    vocabulary = [f"w{n}" for n in range(300)]
    items = [(i, " ".join(random.choice(vocabulary[: 30 if i % 2 else 300], random.integers(5, 60)))) for i in range(150)]
    frequency = {}
    for _, text in items:
        for h in set(map(int, decontaminate._words([text])[0])):
            frequency[h] = frequency.get(h, 0) + 1
    index = decontaminate.build_index(items, frequency, len(items), 30.0)
    dense = np.zeros((len(index.vocabulary), len(items)))
    for t in range(len(index.vocabulary)):
        part = slice(*index.bounds[t : t + 2])
        dense[t, index.items[part]] = index.impacts[part]
    assert np.allclose(dense.sum(axis=0), 1.0)
    for n in range(120):
        terms = np.unique(random.choice(len(index.vocabulary), random.integers(1, 60)))
        if n % 3 == 0:
            terms = np.unique(np.r_[terms, np.flatnonzero(dense[:, n])])
        for threshold in (0.05, 0.3, 0.6):
            scores = dense[terms].sum(axis=0)
            sure = set(np.flatnonzero(scores >= threshold + 1e-9).tolist())
            maybe = set(np.flatnonzero(scores >= threshold - 1e-9).tolist())
            found = {i for i, _ in index.search(terms, threshold)}
            assert sure <= found <= maybe


def test_planted_passages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    wanted = [(r.item_id, normal(r.text)) for r in items.collect()]
    expected = {(r.doc_id, i) for r in docs.select("doc_id", "text").collect() for i, t in wanted if t in normal(r.text)}
    assert expected and found == expected


def test_shards_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 200)
    items = [(n, f"What is the {n}th thing that question{n} wants to know?\nAnswer number{n} is thing{n} of kind{n}.", "x") for n in range(8)]
    items += [(100, None, "x"), (101, "", "x"), (102, "...", "x"), (103, items[0][1], "x"), (None, "A nameless item with several odd words inside.", "x"), (104, "long " + " ".join(f"q{n}" for n in range(300)), "x")]
    filler = " ".join(f"f{n}" for n in range(200))
    docs = [(1, f"{filler} {items[0][1].upper()} {filler}", "x"), (2, items[3][1].split("\n")[0], "x"), (3, None, "x"), (4, "", "x"), (5, filler * 50 + items[7][1], "x"),
            (6, "A nameless item, with several odd words inside", "x"), (7, filler + " " + items[-1][1], "x"), (7, filler + " " + items[-1][1], "x"), (None, items[1][1], "x")]
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string, item_id string"), spark.createDataFrame(items, "item_id long, text string, score string"))
    got = sorted(((r.doc_id, r.item_id) for r in found.collect()), key=str)
    assert got == sorted([(1, 0), (1, 103), (5, 7), (6, None), (7, 104), (7, 104), (None, 1)], key=str)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string, item_id string"), empty).count() == 0
