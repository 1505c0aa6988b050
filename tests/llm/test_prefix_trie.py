"""The prefix trie against a plain one."""

import hashlib
import random
import zlib

import pytest

from hazemart.llm import prefix_trie
from hazemart.llm.prefix_trie import Tree, slice_nodes, trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def order(row):
    digest = hashlib.md5(f"{len(row[2] or '')}:{row[2] or ''}{row[3] or ''}".encode()).hexdigest()
    return (row[1] is not None, row[1] or 0, row[2] or "", digest)


def brute(rows):
    talks = {}
    for row in sorted((r for r in rows if r[0] is not None), key=order):
        talks.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    whole = {}
    for c, turns in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c - 5 * int(c / 5))
        whole[c] = tuple(talks.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids.get(node, [])]
        own = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        sums[node] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))

    out = []
    for node, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(whole[c]) == len(node))))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(kids.get(node, [])), *sums[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def talk(count, seed):
    draw = random.Random(seed)
    rows = []
    for c in range(-7, count):
        if c % 10 == 5 and c % 3:
            continue  # a base that is absent
        for t in range(draw.choice([1, 2, 3, 5, 9, 14])):
            hot = c % 3 == 0
            text = "hot" * t if hot else draw.choice(["a", "b", "ü", "", None])
            rows.append((c, t if t % 4 else None, draw.choice(["user", None, ""]) if not hot else "user", text))
    rows += [rows[3], rows[3], (None, 1, "user", "lost"), (None, None, None, None), (10_000, 7, None, None)]
    rows += [(20_000, t, "user", "x" * (t % 7)) for t in range(1200)]
    return rows


@pytest.mark.parametrize("turns", [40, 400, 1 << 18])
def test_against_a_plain_trie(spark, monkeypatch, turns):
    monkeypatch.setattr(prefix_trie, "SLICE_TURNS", turns)
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    rows = talk(250, turns)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, key string")
    found = trie(frame.repartition(3))
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_empty_and_single(spark):
    frame = spark.createDataFrame([(5, 0, "user", "é")], "conv_id long, turn long, role string, text string")
    assert trie(frame.limit(0)).count() == 0
    assert sorted(map(tuple, trie(frame).collect()), key=str) == brute([(5, 0, "user", "é")])


def test_layouts_grow_and_paths_stay_short():
    draw = random.Random(1)
    for count in (3, 4, 5, 16, 17, 48, 49, 300):
        keys = [bytes(draw.randrange(256) for _ in range(16 * draw.randint(0, 3))) for _ in range(count)] + [b""]
        tree = Tree(keys)
        nodes = list(tree.bottom_up())
        assert sorted(m for n, _, _ in nodes for m in n.ends) == list(range(len(keys)))
        assert len(nodes) <= 2 * len(set(keys)) + 1
        found = {k for n, _, e in nodes for m in n.ends for k in [keys[m]] if len(k) == e}
        assert found == set(keys)
    layouts = {type(n.kids).__name__ for n, _, _ in nodes if n.kids is not None}
    assert "DirectKids" in layouts and len(slice_nodes([b""], [[]], [4], None, None)) == 1
