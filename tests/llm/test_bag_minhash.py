"""BagMinHash signatures, exact overlap and near-duplicate classes."""

import collections
import random
import re

import numpy as np
import pyarrow as pa

from hazemart.llm import bag_minhash


def bag(text):
    words = re.findall(r"[0-9A-Za-z_\x80-\U0010ffff]+", (text or "").lower())
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else None


def similarity(a, b):
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


def classes(rows):
    bags = {i: bag(t) for i, t in rows}
    root = {i: i for i in bags}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in bags if bags[i])
    for a in ids:
        for b in ids:
            if a < b and similarity(bags[a], bags[b]) >= 0.8:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in bags}


def test_signatures_are_unbiased_on_multisets():
    random_ = np.random.default_rng(2)
    agree = []
    left = np.r_[np.full(25, 1), np.full(15, 3), np.full(10, 9)]
    right = np.r_[np.full(20, 2), np.full(20, 3), np.full(10, 6)]
    truth = np.minimum(left, right).sum() / np.maximum(left, right).sum()
    for _ in range(60):
        items = random_.integers(0, 1 << 63, 50, dtype=np.uint64)
        owner = np.r_[np.zeros(50, int), np.ones(50, int)]
        found = bag_minhash.signatures(owner, np.r_[items, items], np.r_[left, right], 2, 168)
        agree.append((found[0] == found[1]).mean())
    assert abs(np.mean(agree) - truth) < 4 * np.std(agree) / 60**0.5


def test_overlap_is_exact():
    draw = random.Random(3)
    texts = [" ".join(draw.choice("a b c d e".split()) for _ in range(draw.randint(0, 30))) for _ in range(60)]
    other = [t if draw.random() < 0.3 else " ".join(t.split()[: draw.randint(0, 30)]) for t in texts]
    found = bag_minhash.overlap(pa.array(texts), pa.array(other))
    for a, b, value in zip(texts, other, found):
        expected = similarity(bag(a), bag(b)) if bag(a) and bag(b) else 0.0
        assert abs(value - expected) < 1e-12


def test_classes_against_brute_force(spark):
    draw = random.Random(6)
    vocabulary = [f"w{n}" for n in range(400)]
    base = [[draw.choice(vocabulary) for _ in range(draw.randint(40, 90))] for _ in range(20)]
    rows = [(n, " ".join(words)) for n, words in enumerate(base)]
    for n in range(20, 160):
        words = list(base[0] if n % 3 == 0 else draw.choice(base))
        for _ in range(draw.randint(0, 3)):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        rows.append((n, " ".join(words)))
    rows += [(200, "Same short text"), (201, "same SHORT, text!"), (202, ""), (203, ""), (204, None), (205, "..."), (206, "z " * 3000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows] + [(None, rows[0][1], "x"), (*rows[3], "x")], "doc_id long, text string, class_id string")
    found = bag_minhash.near_duplicates(docs.repartition(6))
    assert found.columns == ["doc_id", "class_id", "kept"]
    got = found.collect()
    assert len(got) == len(rows) + 2
    expected = classes(rows)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == expected
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.class_id) for r in got)
    assert len(set(expected.values())) < len(rows)
    assert bag_minhash.near_duplicates(docs.limit(0)).count() == 0


def test_buckets_are_split_by_further_registers(spark, monkeypatch):
    """Without any further leader the longer bands find the links, at the threshold and beside it, and few of the other pairs."""
    monkeypatch.setattr(bag_minhash, "LEADER_ROUNDS", 0)
    draw = random.Random(4)
    base = [f"b{n}" for n in range(300)]
    rows = []
    for n in range(160):  # pairs of copies from about 0.65 to 0.9 of each other, far from all others
        if n % 2 == 0:
            words = list(base)
            for k in draw.sample(range(300), 14):
                words[k] = f"x{n}-{k}"
        else:
            words = list(words)
            for k in draw.sample(range(300), draw.randint(3, 9)):
                words[k] = f"y{n}-{k}"
        rows.append((n, " ".join(words)))
    bags = {i: bag(t) for i, t in rows}
    near = {(a, b) for a in bags for b in bags if a < b and similarity(bags[a], bags[b]) >= 0.8}
    compared = []
    verified = bag_minhash._verified
    monkeypatch.setattr(bag_minhash, "_verified", lambda pairs, *rest: (compared.append(pairs.distinct().count()), verified(pairs, *rest))[1])
    found = {r.doc_id: r.class_id for r in bag_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(near) > 20
    caught = sum(found[a] == found[b] for a, b in near)
    assert caught >= 0.9 * len(near)
    wanted = classes(rows)
    assert all(wanted[a] == wanted[b] for a in found for b in found if found[a] == found[b])
    assert compared[-1] < 0.4 * 160 * 159 / 2


def test_a_drifting_chain_is_one_class(spark):
    """A bucket whose leader links with few members still yields every link."""
    draw = random.Random(9)
    words = [f"v{n}" for n in range(60)]
    rows, current = [], words
    for n in range(40):  # a drifting chain: neighbours link, ends do not
        current = list(current)
        current[(n * 7) % 60] = f"x{draw.randint(0, 9999)}"
        rows.append((n, " ".join(current)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in bag_minhash.near_duplicates(docs).collect()} == classes(rows)


def test_texts_that_share_too_little_are_not_compared_pair_by_pair(spark, monkeypatch):
    """Many texts just below the threshold of a text and of each other; a pair at the threshold among them is still found."""
    draw = random.Random(11)
    base = [f"b{n}" for n in range(150)]
    rows = [(0, " ".join(base))]
    for n in range(1, 121):  # 4 of 150 words changed: 20 of 146 shingles, 0.76 of the base, about 0.6 of each other
        words = list(base)
        for k in draw.sample(range(5, 145, 10), 4):
            words[k] = f"x{n}-{k}"
        rows.append((n, " ".join(words)))
    words = rows[60][1].split()
    rows.append((200, " ".join(words[:-14])))  # shorter by 14: 132 of 146
    rows.append((201, " ".join(["y", *words[1:]])))
    compared = []
    verified = bag_minhash._verified
    monkeypatch.setattr(bag_minhash, "_verified", lambda pairs, *rest: (compared.append(pairs.distinct().count()), verified(pairs, *rest))[1])
    found = {r.doc_id: r.class_id for r in bag_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == classes(rows)
    assert len(set(found.values())) > 100
    assert compared[-1] < 10


def test_no_link_is_left_out_for_what_texts_share(spark):
    draw = random.Random(12)
    vocabulary = [f"w{n}" for n in range(30)]
    base = [[draw.choice(vocabulary) for _ in range(60)] for _ in range(4)]
    rows = []
    for n in range(120):
        words = list(draw.choice(base))
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        rows.append((n, " ".join(words[: draw.randint(45, 60)] + words[:5] * draw.randint(0, 3))))
    bags = {i: bag(t) for i, t in rows}
    # components as they may stand: some of what is linked is already one
    component = {i: i if i % 3 else 0 for i in bags}
    frame = spark.createDataFrame([(i, component[i], t) for i, t in rows], "_id long, component long, _text string")
    kept = {r["_id"] for r in bag_minhash._linkable(frame, 5, 0.8).collect()}
    wanted = {a for a in bags for b in bags if component[a] != component[b] and similarity(bags[a], bags[b]) >= 0.8}
    assert wanted and wanted <= kept < set(bags)
