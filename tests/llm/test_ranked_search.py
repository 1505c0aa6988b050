"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import pytest

from hazemart.llm import ranked_search
from hazemart.llm.ranked_search import ranked, term_counts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, top):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    documents, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    wanted = {}
    for i, text in items:
        wanted.setdefault(i, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        rows = []
        for i, bag in bags:
            m = 100 - 50 + (50 * sum(bag.values()) * documents) // total
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m))
                for t in own if t in bag
            )
            if score > 0:
                rows.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out, key=str)


def corpus(count, seed=3):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Éa", "straße", "ÄB", "x1", "日本"]
    docs = []
    for i in range(count):
        text = " ".join(draw.choice(words[: draw.randint(5, 65)]) for _ in range(int(draw.expovariate(0.03)) + 1))
        docs.append((i, text if i % 11 else text.upper().replace(" ", ", ")))
    docs += [(k + count, docs[7][1]) for k in range(80)]  # copies beyond the last place
    docs += [docs[3], docs[3], (None, docs[4][1]), (None, None), (9001, None), (9002, ""), (9003, "--- !"), (9004, "w1 " * 5000)]
    items = [(k, " ".join(draw.choice(words) for _ in range(draw.randint(1, 30)))) for k in range(30)]
    items += [(40, None), (41, ""), (42, "unheard of"), (43, docs[7][1]), (3, "w7"), (None, "w1 w2"), (None, "w3")]
    return docs, items


@pytest.mark.parametrize("block", [16, 2048])
def test_against_all_scores(spark, monkeypatch, block):
    monkeypatch.setattr(ranked_search, "BLOCK", block)
    docs, items = corpus(400)
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, _id int, n int").repartition(3)
    asked = spark.createDataFrame([(*i, 5) for i in items], "item_id long, text string, score int")
    found = ranked(frame, asked, 20)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items, 20)


def test_shards_give_the_same(spark, monkeypatch):
    docs, items = corpus(60, 5)
    monkeypatch.setattr(ranked_search, "SHARD_BYTES", 400)
    found = ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 5)
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items, 5)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked(docs.limit(0), items).count() == 0 and ranked(docs, items.limit(0)).count() == 0
    assert [r.score for r in ranked(docs, items).collect()] == [math.floor(1000 * math.log(4 / 3)) * (10**9 // 3000)]


def test_bounds_hold_and_pieces_join():
    assert term_counts(b"ab" * 900_000 + b" C-c " + "É".encode())[b"c"] == 2
    assert sum(term_counts(b"one two " * 400_000).values()) == 800_000
