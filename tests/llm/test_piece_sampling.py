"""Sampled segmentations against an enumeration of the lattice, and exact decoding."""

import collections
import math

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hazemart.llm import kernel, piece_sampling

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocab():
    return piece_sampling.vocabulary(PATH)


def enumerate_all(vocab, raw):
    look = {vocab.pieces[i]: (int(i), w) for i, w in zip(vocab.ids, vocab.weights)}

    def rest(at):
        if at == len(raw):
            yield (), 0.0
        for end in range(at + 1, len(raw) + 1):
            if raw[at:end] in look:
                piece, weight = look[raw[at:end]]
                for pieces, more in rest(end):
                    yield (piece, *pieces), weight + more

    found = list(rest(0))
    total = np.logaddexp.reduce([w for _, w in found])
    return {s: math.exp(w - total) for s, w in found}


def test_samples_follow_the_lattice_without_replacement(vocab):
    truth = enumerate_all(vocab, b" the")
    n = 6000
    found = piece_sampling.sample_rows(pa.array(["the"] * n), kernel.mixed(np.arange(n, dtype=np.uint64)), 2, vocab)
    first = collections.Counter(tuple(f[2].tolist()) for f in found if f[1] == 1)
    second = collections.Counter(tuple(f[2].tolist()) for f in found if f[1] == 2)
    for s, p in sorted(truth.items(), key=lambda x: -x[1])[:4]:
        later = sum(q * p / (1 - q) for o, q in truth.items() if o != s)
        assert abs(first[s] / n - p) < 0.03 and abs(second[s] / n - later) < 0.03
    by_row = collections.defaultdict(set)
    for f in found:
        by_row[f[0]].add(tuple(f[2].tolist()))
        assert abs(truth[tuple(f[2].tolist())] - math.exp(f[3])) < 1e-9
    assert all(len(s) == 2 for s in by_row.values())
    # probability over inclusion probability is an unbiased estimate of the whole mass
    assert abs(sum(math.exp(f[3] - f[4]) for f in found) / n - 1) < 0.02


def test_all_segmentations_are_found_once(vocab):
    truth = {a + b: p * q for a, p in enumerate_all(vocab, b" ab").items() for b, q in enumerate_all(vocab, b" cd").items()}
    found = piece_sampling.sample_rows(pa.array(["ab cd"]), np.array([7], np.uint64), 1000, vocab)
    assert {tuple(f[2].tolist()) for f in found} == set(truth) and len(found) == len(truth)
    assert all(f[4] == 0.0 for f in found)


def test_rows_and_decoding(spark, vocab):
    texts = ["Hello world\nagain", "", None, "x\n\ny  z ", "漢字 ▁ é\x00 \U0001f600", "été", "a" * 500, " ", "\n", "same", "same"]
    docs = spark.createDataFrame([(i if i < 9 else 9, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x")], "doc_id long, text string, ids string")
    found = piece_sampling.sampled_segmentations(docs, PATH, 3)
    rows = found.collect()
    assert all(r.restored for r in rows)
    expected = {i if i < 9 else 9: t or "" for i, t in enumerate(texts)} | {None: "no id"}
    for r in piece_sampling.decoded(found, PATH).collect():
        assert r.text == expected[r.doc_id]
        assert piece_sampling.digest(np.array(r.ids, np.int32)) == r.ids_digest and len(r.ids) == r.n_tokens
    assert [(r["sample"], r.n_tokens, r.log_prob, r.log_inclusion) for r in rows if r.doc_id == 1] == [(1, 0, 0.0, 0.0)]
    twins = collections.Counter((r["sample"], tuple(r.ids)) for r in rows if r.doc_id == 9)
    assert set(twins.values()) == {2}
    again = {(r.doc_id, r["sample"], tuple(r.ids)) for r in piece_sampling.sampled_segmentations(docs.repartition(3), PATH, 3).collect()}
    assert again == {(r.doc_id, r["sample"], tuple(r.ids)) for r in rows}
    assert piece_sampling.sampled_segmentations(docs.limit(0), PATH).count() == 0
    assert found.where(F.col("sample") > 3).count() == 0


def test_digests_of_sequences_end_to_end():
    draw = np.random.default_rng(5)
    sizes = np.array([0, 3, 0, 2000, 1, 0])
    ids = draw.integers(0, 32000, sizes.sum()).astype(np.int32)
    parts = np.split(ids, np.cumsum(sizes)[:-1])
    assert piece_sampling.digests(ids, sizes).tolist() == [piece_sampling.digest(x) for x in parts]
    assert piece_sampling.digests(ids[:0], np.zeros(2, int)).tolist() == [0, 0]


def test_kept_lattices_are_not_copied_for_each_slice(vocab, monkeypatch):
    texts = [f"the {w} of text number {n}" for n in range(40) for w in ("first", "second half", "漢字", "q" * 30)]
    keys = kernel.mixed(np.arange(len(texts), dtype=np.uint64))
    plain = lambda found: [(f[0], f[1], f[2].tolist(), f[3], f[4]) for f in found]
    whole = [plain(piece_sampling.sample_rows(pa.array([t]), keys[n : n + 1], 3, vocab)) for n, t in enumerate(texts)]
    for limit in (10, 400, piece_sampling.CACHED_EDGES):  # nothing kept, some, all
        monkeypatch.setattr(piece_sampling, "CACHED_EDGES", limit)
        cache = piece_sampling.LatticeCache(vocab)
        assert [plain(piece_sampling.sample_rows(pa.array([t]), keys[n : n + 1], 3, vocab, cache)) for n, t in enumerate(texts)] == whole
    body = np.frombuffer(b" one two", np.uint8)
    codes = kernel.word_hashes(body, np.array([0, 4]), np.array([4, 8]))
    first, _ = cache.of(body, np.array([0]), np.array([4]), codes[:1])
    second, _ = cache.of(body, np.array([0, 4]), np.array([4, 4]), codes)
    third, _ = cache.of(body, np.array([0, 4]), np.array([4, 4]), codes)
    assert np.shares_memory(second.log_p, third.log_p)


def test_pieces_and_next_edges_are_found_without_a_search(vocab):
    high = (vocab.hashes >> np.uint64(64 - piece_sampling.FILTER_BITS)).astype(np.int64)
    kept, first = np.unique(high, return_index=True)
    assert (vocab.slots[kept] == first).all() and (vocab.slots >= 0).sum() == len(kept) < len(high)  # some slots are shared
    body = np.frombuffer(b" one two" + " 漢字".encode(), np.uint8)
    cache = piece_sampling.LatticeCache(vocab)
    for starts, sizes in (([0], [4]), ([4, 0, 8], [4, 4, 7])):  # the second lattice lies behind the kept one
        starts, sizes = np.array(starts), np.array(sizes)
        lattice, root = cache.of(body, starts, sizes, kernel.word_hashes(body, starts, starts + sizes))
        degree = lattice.degree[lattice.target]
        assert (lattice.onward == np.where(degree > 0, lattice.first[lattice.target] + degree - 1, -1)).all()
        assert (lattice.last(root) == lattice.first[root] + lattice.degree[root] - 1).all()
