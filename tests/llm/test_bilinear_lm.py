"""Token counts and base scores against brute force; the model normalises and beats the base on held-out texts."""

import collections
import math
import tracemalloc
import zlib

import numpy as np
from pyspark.sql import functions as F

from hazemart.llm import bilinear_lm, kernel


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string").repartition(4)
    found = bilinear_lm.scored(docs, F.crc32(F.col("doc_id").cast("string")) % 10 != 0).collect()
    counts = collections.Counter()
    split = {i: [*(t or "").encode().lower().split(), b" "] for i, t in rows}
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            counts.update(split[i])
    total, distinct = sum(counts.values()), len(counts)
    assert len(found) == len(rows)
    for r in found:
        words = split[r.doc_id]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(w in counts for w in words), total)
        assert abs(r.base_score - base) < 1e-6
        assert r.score < 0
    return found


def test_base_scores_and_gain(spark, monkeypatch):
    monkeypatch.setattr(bilinear_lm, "LEXICON", 500)
    monkeypatch.setattr(bilinear_lm, "STEPS", 400)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(9001, None), (9002, ""), (9003, "A\x0bB a\x0cb a b"), (9004, "é É \xa0 x"), (9005, "word " * 5000), (9003, "A\x0bB a\x0cb a b")]
    found = check(spark, rows)
    held = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 10 == 0]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    found = bilinear_lm.scored(docs, F.crc32(F.col("doc_id").cast("string")) % 10 != 0).collect()
    assert sorted(r.n_tokens for r in found) == [1, 3] and {(r.n_known, r.train_tokens) for r in found} == {(0, 0)}
    assert bilinear_lm.scored(docs.limit(0), F.lit(True)).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " "), (2, None)], "doc_id long, text string")
    assert {(r.n_tokens, r.n_known, r.train_tokens) for r in bilinear_lm.scored(blank, F.lit(True)).collect()} == {(1, 1, 3)}


def test_training_finds_a_pattern_and_probabilities_add_up():
    """Class c follows c - 1 and c - 2 in nine of ten cells."""
    n = 20
    random = np.random.default_rng(1)
    a = random.integers(0, n, 400)
    c = np.where(random.random(400) < 0.9, (a + 2) % n, random.integers(0, n, 400))
    cells = (a * bilinear_lm.CLASSES + (a + 1) % n) * bilinear_lm.CLASSES + c
    found, counts = np.unique(cells, return_counts=True)
    table = bilinear_lm.train(found, counts).log_probabilities()
    assert np.allclose(np.exp(table).sum(axis=2), 1.0)
    assert np.mean([table[x, (x + 1) % n].argmax() == (x + 2) % n for x in range(n)]) > 0.9


def test_tokens_of_one_class_are_told_apart():
    """Words of one shape class, where the first of two tells the second: its share in the class must not be all that counts."""
    shapes, counts = np.full(300, 7), np.repeat([5000, 1000], [100, 200])
    codes = np.arange(1, 301)
    shape = bilinear_lm.tree(codes, shapes, counts, {7: (int(counts.sum()), 300), -1: (100, 1)})
    start = bilinear_lm.network(shape, bilinear_lm.train(np.zeros(0, np.int64), np.zeros(0, np.int64)))
    learner = bilinear_lm.Learner(shape, start)
    first = np.random.default_rng(6).integers(100, 200, 100_000)
    units = np.stack([first, first + 100], axis=1).reshape(-1)
    learner.learn(units, np.arange(len(units)) // 1000)
    told, other = np.arange(100, 200), np.roll(np.arange(200, 300), 7)
    context = [np.full(100, shape.end), told]
    for weights, least, most in ((start, -0.01, 0.01), (learner.now, 0.5, 9.0)):
        score = bilinear_lm.scorer(shape, weights)
        assert least < np.mean(score.log10_after(context, told + 100) - score.log10_after(context, other)) < most


def test_units_add_up_to_one_and_examples_grow():
    random = np.random.default_rng(2)
    codes = random.integers(1, 1 << 62, 700)
    shapes, counts = random.integers(0, bilinear_lm.SHAPES, 700), np.sort(random.integers(1, 500, 700))[::-1]
    totals = {s: (int(counts[shapes == s].sum()) + 40, int((shapes == s).sum()) + 9) for s in range(bilinear_lm.SHAPES)}
    shape = bilinear_lm.tree(codes, shapes, counts, {**totals, -1: (30, 1)})
    start = bilinear_lm.network(shape, bilinear_lm.train(np.zeros(0, np.int64), np.zeros(0, np.int64)))
    learner = bilinear_lm.Learner(shape, start)
    for size in (3000, 9000):
        learner.learn(random.integers(0, shape.end + 1, size), np.sort(random.integers(0, 50, size)))
    assert learner.examples == 12000 and learner.times[0].sum() == 24000
    units = np.arange(shape.end + 1)
    for context in ((3, 5), (shape.end, shape.end), (600, 710)):
        found = bilinear_lm.scorer(shape, learner.now).log10_after([np.full(len(units), c) for c in context], units)
        assert abs((10**found).sum() - 1) < 1e-4


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    """Several parts on 2 and on 12 partitions, in another order of rows, with repeated rows and one id of two texts."""
    monkeypatch.setattr(bilinear_lm, "LEXICON", 400)
    monkeypatch.setattr(bilinear_lm, "STEPS", 50)
    monkeypatch.setattr(bilinear_lm, "PART_TOKENS", 9000)
    monkeypatch.setattr(bilinear_lm, "MIXED_TOKENS", 2000)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(120).collect()]
    rows += [*rows[:3], (rows[0][0], "another text of the first id"), (None, None)]
    found = []
    for partitions, some in ((2, rows), (12, rows[::-1])):
        docs = spark.createDataFrame(some, "doc_id long, text string").repartition(partitions)
        scored = bilinear_lm.scored(docs, F.crc32(F.col("doc_id").cast("string")) % 10 != 0)
        found.append(sorted((r.doc_id or -1, r.n_tokens, r.base_score, r.score) for r in scored.collect()))
    for one, other in zip(*found, strict=True):
        assert one[:2] == other[:2] and abs(one[2] - other[2]) < 1e-6 and abs(one[3] - other[3]) < 1e-6 * one[1]


def test_units_survive_packing():
    counts = np.array([0, 3, 1, 0, 4])
    units = np.array([0, 255, 256, 65535, 65536, 131071, 131104, 7])
    column = bilinear_lm.packed(units, counts)
    back, sizes = bilinear_lm.unpacked(column)
    assert back.tolist() == units.tolist() and sizes.tolist() == counts.tolist()
    back, sizes = bilinear_lm.unpacked(column.slice(1, 2))
    assert back.tolist() == units[:4].tolist() and sizes.tolist() == [3, 1]


def test_scores_equal_a_plain_loop():
    """Every step of the tree in doubles, one token after another, with scores within and beyond the safe range."""
    random = np.random.default_rng(4)
    codes = random.integers(1, 1 << 62, 400)
    shapes, counts = random.integers(0, bilinear_lm.SHAPES, 400), np.sort(random.integers(1, 500, 400))[::-1]
    totals = {s: (int(counts[shapes == s].sum()) + 40, int((shapes == s).sum()) + 9) for s in range(bilinear_lm.SHAPES)}
    shape = bilinear_lm.tree(codes, shapes, counts, {**totals, -1: (30, 1)})
    start = bilinear_lm.network(shape, bilinear_lm.train(np.zeros(0, np.int64), np.zeros(0, np.int64)))
    # weights are single precision: at 8.0, scores of thousands, the fourth digit is rounding
    for scale in (0.3, 2.0):
        for outputs in start.outputs:
            outputs[:] = random.normal(0, scale, outputs.shape)
        start.vectors[:] = random.normal(0, scale, start.vectors.shape)
        scorer = bilinear_lm.scorer(shape, start)
        highest = (scorer.moved[0] + scorer.moved[1]) @ scorer.outputs[2].T
        assert (highest.max() < math.log(bilinear_lm.LARGE)) == (scale < 1)
        units, rows = random.integers(0, shape.end + 1, 300), np.sort(random.integers(0, 9, 300))
        found = scorer.log10(units, rows)
        for k, unit in enumerate(units):
            before = [units[k - d] if k >= d and rows[k - d] == rows[k] else shape.end for d in (2, 1)]
            hidden = sum(start.vectors[b].astype(float) @ p for b, p in zip(before, start.positions, strict=True))
            of, rank = shape.classes[unit], int(np.flatnonzero(shape.order == unit)[0])
            steps = [(0, of, range(bilinear_lm.CLASSES)), (1, shape.groups[unit], range(*shape.class_starts[of : of + 2])),
                     (2, rank, range(*shape.group_starts[shape.groups[unit] :][:2]))]
            plain = 0.0
            for level, choice, among in steps:
                scores = {j: hidden @ start.outputs[level][j] + start.biases[level][j] for j in among}
                top = max(scores.values())
                plain += (scores[choice] - top - math.log(sum(math.exp(x - top) for x in scores.values()))) / math.log(10)
            assert abs(plain - found[k]) < 1e-4 * max(1.0, abs(plain))


def test_the_lexicon_is_searched_by_high_bits():
    draw = np.random.default_rng(8)
    lexicon = np.unique(np.r_[draw.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2), np.arange(40, dtype=np.uint64), np.uint64(2**64 - 5)])
    asked = np.r_[lexicon, lexicon + np.uint64(1), draw.integers(0, 1 << 63, 3000, dtype=np.uint64), np.array([0, 2**64 - 1, 2**64 - 7], np.uint64)]
    none = np.zeros(0, np.int64)
    for some in (lexicon, lexicon[:1], lexicon[-2:]):
        shape = bilinear_lm.Tree(some, np.arange(len(some)), none, none, none, none, none, none)
        assert shape.places(asked).tolist() == np.minimum(np.searchsorted(some, asked), len(some) - 1).tolist()
        units = shape.units(asked, np.arange(len(asked)) % 33 - 1)
        known = np.isin(asked, some) & (np.arange(len(asked)) % 33 > 0)
        assert (units[known] < len(some)).all() and (some[units[known]] == asked[known]).all() and (units[~known] >= len(some)).all()


def test_sums_of_runs_of_all_lengths_and_powers_that_are_kept(monkeypatch):
    draw = np.random.default_rng(4)
    at = np.repeat([5, 0, 9, 7, 2, 3], [1, 2, 7, 8, 9, 60])
    at = at[draw.permutation(len(at))]
    rows = draw.normal(size=(len(at), 24)).astype(np.float32)
    found, sums, counts = bilinear_lm._grouped(at, rows)
    order = np.argsort(at, kind="stable")
    assert found.tolist() == [0, 2, 3, 5, 7, 9] and counts.tolist() == [2, 9, 60, 1, 8, 7]
    assert np.array_equal(sums, np.add.reduceat(rows[order], np.cumsum(counts) - counts))
    body = draw.integers(0, 256, 3000).astype(np.uint8)
    starts, ends = np.arange(0, 2900, 10), np.arange(0, 2900, 10) + 7
    hashes = kernel.word_hashes(body, starts, ends)
    kept = kernel._kept_powers[0]
    assert np.array_equal(kernel.word_hashes(body[:100], starts[:5], ends[:5]), hashes[:5]) and kernel._kept_powers[0] is kept
    monkeypatch.setattr(kernel, "_kept_powers", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    monkeypatch.setattr(kernel, "KEPT_POWERS", 10)  # too long to be kept
    assert np.array_equal(kernel.word_hashes(body, starts, ends), hashes) and len(kernel._kept_powers[0]) == 1


def test_memory_of_scoring_does_not_hold_every_hidden_unit(monkeypatch):
    """Of a slice of many tokens only numbers are held; scores are the same in whatever rows hidden units are held."""
    random = np.random.default_rng(5)
    codes = random.integers(1, 1 << 62, 400)
    shapes, counts = random.integers(0, bilinear_lm.SHAPES, 400), np.sort(random.integers(1, 500, 400))[::-1]
    totals = {s: (int(counts[shapes == s].sum()) + 40, int((shapes == s).sum()) + 9) for s in range(bilinear_lm.SHAPES)}
    shape = bilinear_lm.tree(codes, shapes, counts, {**totals, -1: (30, 1)})
    start = bilinear_lm.network(shape, bilinear_lm.train(np.zeros(0, np.int64), np.zeros(0, np.int64)))
    for outputs in start.outputs:
        outputs[:] = random.normal(0, 0.3, outputs.shape)
    scorer = bilinear_lm.scorer(shape, start)
    units, rows = random.integers(0, shape.end + 1, 400_000), np.arange(400_000) // 900
    peaks = []
    for count in (200_000, 400_000):
        tracemalloc.start()
        whole = scorer.log10(units[:count], rows[:count])
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] - peaks[0] < 200_000 * 4 * bilinear_lm.WIDTH  # less than one hidden unit a token
    few = scorer.log10(units[:3000], rows[:3000])
    assert np.allclose(whole[:3000], few, atol=1e-5)
    monkeypatch.setattr(bilinear_lm, "HELD_ROWS", 7, raising=False)
    assert np.allclose(scorer.log10(units[:3000], rows[:3000]), few, atol=1e-5)
