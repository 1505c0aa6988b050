"""Exact near-duplicate vectors within labels by a cover tree and its dual traversal.

A bounded sample of each label spans the upper part of a cover tree: nested levels of centres with
halving radii, each centre below its nearest centre of the level above. Every vector belongs to its
nearest lowest centre and to a ring of distances around it; that is a cell. The traversal starts with
the pair (root, root) and splits pairs of nodes level by level. A pair is dropped when the distance of
the centres less both covering radii, as measured over all vectors, is beyond the link distance; at
the cells the inner radii of the rings count too. Surviving pairs of cells are compared as blocks of
bounded size by matrix products, so links are exact and none is ever listed: a task returns counts
and a spanning forest.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazemart.llm.components import components, forest
from hazemart.session import settled

COSINE = 0.93
CENTRES_PER_LABEL = 256
CENTRES = 16_384
LEVELS = 4  # radii 2, 1, 1/2, 1/4
RING = 0.125
BLOCK = 1024
SLACK = 1e-9


@dataclass
class Tree:
    """centres (n, d); per level the indexes into centres and the position of each one's parent in the level above."""

    centres: np.ndarray
    levels: list[np.ndarray]
    parents: list[np.ndarray]


def build_tree(points: np.ndarray) -> Tree:
    level, levels, parents = np.array([0]), [np.array([0])], [np.array([0])]
    for depth in range(1, LEVELS):
        radius = 2.0 / 2**depth
        near = _distances(points, points[level]).min(axis=1)
        added = list(level)
        while near.max() > radius:
            far = int(near.argmax())
            added.append(far)
            near = np.minimum(near, _distances(points, points[[far]])[:, 0])
        above, level = level, np.array(added)
        levels.append(level)
        parents.append(_distances(points[level], points[above]).argmin(axis=1))
    return Tree(points, levels, parents)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def dual_traversal(tree: Tree, leaf: np.ndarray, low: np.ndarray, high: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of cells (first <= second) that may hold vectors within ``reach``; a cell is a ring [low, high] around a leaf."""
    cover = [np.zeros(len(x)) for x in tree.levels]
    for depth, level in enumerate(tree.levels):
        node = leaf.copy()
        for d in range(LEVELS - 1, depth, -1):
            node = tree.parents[d][node]
        lowest = tree.centres[tree.levels[-1][leaf]]
        away = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", lowest, tree.centres[level[node]]), 0.0))
        np.maximum.at(cover[depth], node, away + high)
    a, b = np.array([0]), np.array([0])
    for depth in range(1, LEVELS):
        order = np.argsort(tree.parents[depth], kind="stable")
        count = np.bincount(tree.parents[depth], minlength=len(tree.levels[depth - 1]))
        begin = np.cumsum(count) - count
        fan = count[a] * count[b]
        pick = np.arange(int(fan.sum())) - np.repeat(np.cumsum(fan) - fan, fan)
        pa_, pb = np.repeat(a, fan), np.repeat(b, fan)
        a, b = order[begin[pa_] + pick // count[pb]], order[begin[pb] + pick % count[pb]]
        a, b = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)  # children come in either order
        centre = tree.centres[tree.levels[depth]]
        between = _pair_distances(centre, a, b)
        stay = between - cover[depth][a] - cover[depth][b] <= reach + SLACK
        a, b = a[stay], b[stay]
    order = np.argsort(leaf, kind="stable")
    count = np.bincount(leaf, minlength=len(tree.levels[-1]))
    begin = np.cumsum(count) - count
    fan = count[a] * count[b]
    pick = np.arange(int(fan.sum())) - np.repeat(np.cumsum(fan) - fan, fan)
    la, lb = np.repeat(a, fan), np.repeat(b, fan)
    x, y = order[begin[la] + pick // np.maximum(count[lb], 1)], order[begin[lb] + pick % np.maximum(count[lb], 1)]
    between = _pair_distances(tree.centres[tree.levels[-1]], leaf[x], leaf[y])
    bound = np.maximum.reduce([between - high[x] - high[y], low[x] - high[y] - between, low[y] - high[x] - between])
    stay = bound <= reach + SLACK
    x, y = np.minimum(x, y)[stay], np.maximum(x, y)[stay]
    found = np.unique(np.stack([x, y]), axis=1)
    return found[0], found[1]


def _pair_distances(centre: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a))
    for low in range(0, len(a), 65_536):
        part = slice(low, low + 65_536)
        out[part] = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", centre[a[part]], centre[b[part]]), 0.0))
    return out


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    rows = _matrix(column, dim)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow in the squares
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _assign(trees: dict[str, Tree], batch: pa.RecordBatch) -> pa.RecordBatch:
    names = np.array(batch.column("_group").to_pylist(), object)
    cell = np.full(len(names), -1, np.int64)
    ring, away = np.zeros(len(names), np.int64), np.zeros(len(names))
    for name in set(names):
        if (tree := trees.get(name)) is None:
            continue
        at = np.flatnonzero(names == name)
        rows = _unit(batch.column("_vector").take(pa.array(at)), tree.centres.shape[1])
        gaps = _distances(rows, tree.centres[tree.levels[-1]])
        cell[at] = gaps.argmin(axis=1)
        away[at] = gaps.min(axis=1)
        ring[at] = (away[at] / RING).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [*batch.columns, pa.array(cell), pa.array(ring), pa.array(away)], names=[*batch.schema.names, "_leaf", "_ring", "_away"]
    )


def _compare(least: float):
    def run(table: pa.Table) -> pa.Table:
        uid = table.column("_uid").to_numpy()
        side = table.column("_side").to_numpy()
        rows = _unit(table.column("_vector"), len(table.column("_vector")[0]))
        n = len(uid)
        links, first, second = np.zeros(n, np.int64), [], []
        left = np.flatnonzero(side != 1)
        right = np.flatnonzero(side != 0)  # side 2: one block with itself
        for low in range(0, len(left), 512):
            part = left[low : low + 512]
            a, b = np.nonzero(rows[part] @ rows[right].T >= least)
            a, b = part[a], right[b]
            a, b = a[a != b], b[a != b]
            links += np.bincount(a, minlength=n)
            if len(right) and side[right[0]] == 1:
                links += np.bincount(b, minlength=n)
            root = forest(a, b, n)
            joined = np.flatnonzero(root != np.arange(n))
            first.append(joined)
            second.append(root[joined])
        root = forest(np.concatenate(first), np.concatenate(second), n)
        has = links > 0
        return pa.table({"_uid": uid[has], "n_links": links[has], "_root": uid[root[has]]})

    return run


def linked_vectors(
    vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """One row per row of ``vectors``: id, n_links (other vectors of equal label with cosine >= ``cosine``),
    component_id (smallest id reachable over links) and kept (whether that is its own id).

    A vector that is null, empty, zero or holds null or non-finite components, or has a null label,
    links with nothing; so do vectors of different length. Every row is a vector of its own, also
    those with equal ids, and equal rows link with each other. A row with a null id links as any
    other; its component_id is the smallest non-null one and kept is true where there is none. Other
    columns are not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    vector = F.col(vector_col)
    number = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    sound = (
        vector.isNotNull() & F.col(label_col).isNotNull() & F.coalesce(F.forall(vector, number), F.lit(False))
        & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
    )
    rows = settled(vectors.select(
        F.monotonically_increasing_id().alias("_uid"), F.col(id_col).alias("_id"),
        F.when(sound, F.concat_ws("|", F.size(vector).cast("string"), F.col(label_col).cast("string"))).alias("_group"),
        F.when(sound, vector).alias("_vector"),
    ), "vectors")
    usable = rows.where(F.col("_group").isNotNull()).select("_uid", "_group", "_vector")

    ranked = usable.withColumn("_n", F.row_number().over(Window.partitionBy("_group").orderBy(F.xxhash64("_uid"))))
    sample = ranked.where(F.col("_n") <= CENTRES_PER_LABEL).orderBy("_n", "_group").limit(CENTRES).collect()
    by_group: dict[str, list] = {}
    for r in sample:
        by_group.setdefault(r["_group"], []).append(r["_vector"])
    trees = {}
    for name, points in by_group.items():
        if len(points) > 1:
            trees[name] = build_tree(_unit(pa.array(points), len(points[0])))
    shared = spark.sparkContext.broadcast(trees)  # CENTRES vectors at most

    schema = T.StructType([
        *usable.schema.fields, T.StructField("_leaf", T.LongType()), T.StructField("_ring", T.LongType()),
        T.StructField("_away", T.DoubleType()),
    ])
    placed = settled(usable.mapInArrow(lambda batches: (_assign(shared.value, b) for b in batches if b.num_rows), schema), "placed")

    treed = placed.where(F.col("_leaf") >= 0)
    cells = treed.groupBy("_group", "_leaf", "_ring").agg(
        F.count("*").alias("n"), F.min("_away").alias("low"), F.max("_away").alias("high")
    ).collect()
    homes, partners = _blocks(trees, cells, math.sqrt(max(0.0, 2 - 2 * cosine)))
    home = spark.createDataFrame(homes, "_group string, _leaf long, _ring long, _block long, _blocks long")
    pair = spark.createDataFrame(partners, "_group string, _mine long, _other long")
    treed = treed.join(home, ["_group", "_leaf", "_ring"]).select(
        "_uid", "_group", "_vector", (F.col("_block") + F.pmod(F.xxhash64("_uid"), F.col("_blocks"))).alias("_mine")
    ).join(pair, ["_group", "_mine"])
    # labels beyond the sample have no tree: blocks by hash, all pairs of blocks
    flat = placed.where(F.col("_leaf") < 0)
    sizes = flat.groupBy("_group").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("_blocks"))
    flat = flat.join(sizes, "_group").withColumn("_mine", F.pmod(F.xxhash64("_uid"), F.col("_blocks"))).select(
        "_uid", "_group", "_vector", "_mine", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_other")
    )
    columns = ["_uid", "_vector", "_group", F.least("_mine", "_other").alias("_a"), F.greatest("_mine", "_other").alias("_b"),
               F.when(F.col("_mine") == F.col("_other"), 2).when(F.col("_mine") < F.col("_other"), 0).otherwise(1).alias("_side")]
    compared = treed.select(*columns).union(flat.select(*columns))
    out = settled(
        compared.groupBy("_group", "_a", "_b").applyInArrow(_compare(cosine), "_uid long, n_links long, _root long"), "links"
    )
    counts = out.groupBy("_uid").agg(F.sum("n_links").alias("n_links"))
    groups = components(out.select(F.col("_uid").alias("a"), F.col("_root").alias("b"))).withColumnRenamed("node", "_uid")
    named = settled(rows.select("_uid", "_id").join(counts, "_uid", "left").join(groups, "_uid", "left"), "named")
    smallest = named.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("_id").alias("component_id"))
    joined = named.join(smallest, "component", "left")
    component = F.coalesce("component_id", "_id")
    return joined.select(
        F.col("_id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("_id") == component, component.isNull()).alias("kept"),
    )


def _blocks(trees: dict[str, Tree], cells: list, reach: float) -> tuple[list[tuple], list[tuple]]:
    """(group, leaf, ring, first block, blocks) of every cell and (group, block, block) of the pairs to compare, both ways.

    Small cells share a block in tree order, large ones have several of their own.
    """
    homes, partners = [], []
    by_group: dict[str, list] = {}
    for c in cells:
        by_group.setdefault(c["_group"], []).append(c)
    for name, own in by_group.items():
        tree = trees[name]
        path = np.arange(len(tree.levels[-1]))
        trail = [path]
        for depth in range(LEVELS - 1, 0, -1):
            path = tree.parents[depth][path]
            trail.insert(0, path)
        own.sort(key=lambda c: (*(int(t[c["_leaf"]]) for t in trail), c["_ring"]))
        block, filled, ranges = 0, 0, []
        for c in own:
            if filled and filled + c["n"] > BLOCK:
                block, filled = block + 1, 0
            count = -(-c["n"] // BLOCK)
            ranges.append((block, count))
            homes.append((name, c["_leaf"], c["_ring"], block, count))
            if count > 1:
                block, filled = block + count, 0
            else:
                filled += c["n"]
        leaf, low, high = (np.array([c[k] for c in own]) for k in ("_leaf", "low", "high"))
        x, y = dual_traversal(tree, leaf, low, high, reach)
        pairs = set()
        for i, j in zip(x, y, strict=True):
            pairs.update((a, b) for a in range(ranges[i][0], sum(ranges[i])) for b in range(ranges[j][0], sum(ranges[j])))
        partners += sorted({(name, int(a), int(b)) for a, b in pairs} | {(name, int(b), int(a)) for a, b in pairs})
    return homes, partners
