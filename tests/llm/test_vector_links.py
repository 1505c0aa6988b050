"""Vector links against brute force, and the cover tree."""

import numpy as np
import pyarrow as pa

from hazemart.llm import vector_links
from hazemart.llm.components import components, forest


def brute(rows, least):
    out = {}
    good = [(i, v, l) for i, v, l in rows if v and l is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i, _, _ in rows}
    for i, v, l in good:
        for j, w, m in good:
            if i != j and l == m and len(v) == len(w):
                a, b = np.array(v, float), np.array(w, float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= least:
                    links[i].add(j)
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(links[i]), min(seen), i == min(seen))
    return out


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_links, "BLOCK", 16)
    monkeypatch.setattr(vector_links, "CENTRES_PER_LABEL", 24)
    random = np.random.default_rng(5)
    centres = random.normal(size=(12, 8))
    rows = []
    for i in range(420):
        label = 0 if i % 3 == 0 else int(random.integers(1, 4))
        vector = centres[i % (3 if label == 0 else 12)] + random.normal(scale=0.35, size=8)
        rows.append((i, [float(np.float32(x)) for x in vector], label))
    rows += [(500, rows[0][1], 0), (501, [0.0] * 8, 0), (502, None, 0), (503, [1.0, None] * 4, 0), (504, [float("nan")] * 8, 0), (505, rows[0][1], None),
             (506, [1.0, 2.0], 0), (507, [1.0, 2.0], 0), (508, [], 0), (509, [float("inf")] * 8, 0), (510, [1.0] * 8, 77), (511, [2.0] * 8, 77), (512, [1e-30] * 8, 77)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, n_links int").repartition(5)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_links.linked_vectors(frame).collect()}
    assert found == brute(rows, 0.93)
    assert any(n > 1 for n, _, _ in found.values())
    assert vector_links.linked_vectors(frame.limit(0)).count() == 0


def test_labels_without_a_tree(spark, monkeypatch):
    monkeypatch.setattr(vector_links, "CENTRES", 1)
    monkeypatch.setattr(vector_links, "BLOCK", 4)
    random = np.random.default_rng(6)
    base = random.normal(size=5)
    rows = [(i, [float(x) for x in base + random.normal(scale=0.4, size=5)], i % 2) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_links.linked_vectors(frame).collect()} == brute(rows, 0.93)


def test_tree_covers_and_traversal_misses_nothing():
    random = np.random.default_rng(7)
    points = vector_links._unit(pa.array(list(random.normal(size=(200, 4)))), 4)
    tree = vector_links.build_tree(points)
    for depth in range(1, vector_links.LEVELS):
        assert set(tree.levels[depth - 1]) <= set(tree.levels[depth])
        assert vector_links._distances(points, points[tree.levels[depth]]).min(axis=1).max() <= 2.0 / 2**depth
    gaps = vector_links._distances(points, points[tree.levels[-1]])
    leaf, away = gaps.argmin(axis=1), gaps.min(axis=1)
    ring = (away / vector_links.RING).astype(int)
    cells, cell = np.unique(np.stack([leaf, ring]), axis=1, return_inverse=True)
    cell = cell.ravel()
    low, high = np.full(cells.shape[1], 9.0), np.zeros(cells.shape[1])
    np.minimum.at(low, cell, away)
    np.maximum.at(high, cell, away)
    a, b = vector_links.dual_traversal(tree, cells[0], low, high, 0.4)
    kept = set(zip(a.tolist(), b.tolist()))
    close = np.argwhere(vector_links._distances(points, points) <= 0.4)
    assert all((min(cell[i], cell[j]), max(cell[i], cell[j])) in kept for i, j in close)
    assert len(kept) < cells.shape[1] * (cells.shape[1] + 1) / 2


def test_components(spark):
    random = np.random.default_rng(8)
    pairs = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(int(a), int(b)) for a, b in random.integers(200, 260, (40, 2))]
    nodes = sorted({n for p in pairs if p[0] != p[1] for n in p})
    index = {n: k for k, n in enumerate(nodes)}
    used = [p for p in pairs if p[0] != p[1]]
    label = forest(np.array([index[a] for a, _ in used]), np.array([index[b] for _, b in used]), len(nodes))
    found = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {n: nodes[label[k]] for k, n in enumerate(nodes)}
