"""Near-duplicate documents by BagMinHash on multisets of word shingles.

Each distinct shingle owns Poisson processes of points (time, register). Its multiplicity is cut into
dyadic blocks of occurrences (1, 2, 3-4, 5-8, ...): block k is one process with as many unit
processes' rate as it has occurrences, and every point falls on one occurrence. Bags that reach an
occurrence share its points, so a register's earliest point agrees between two bags with exactly
the probability of their weighted Jaccard similarity. Only points up to a horizon are made; most
shingles have none and cost one hash.

Signatures are banded. Exact copies are one class and enter once. Every text is compared with the leader
of each of its buckets, and texts still apart with further leaders, so a bucket of near copies costs a
multiple of its size. Buckets that then still hold several components are split. Texts that have too few shingles in common with
all texts of other components there can link with none of them and are left out, which is exact. The others get further, independent
registers and many more, longer bands, in which texts well below the threshold seldom meet. Only texts of different
components that share one of those are compared pair by pair. Every candidate is verified by the exact multiset overlap.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazemart.llm import kernel
from hazemart.llm.components import components
from hazemart.session import release, settled

WIDTH = 5
SIMILARITY = 0.8
BANDS = 28
ROWS = 6
#: rounds of leaders, and rounds of labels between them
LEADER_ROUNDS = 4
LABEL_ROUNDS = 5
#: bands and rows of the further registers that split a bucket of several components; a pair at the threshold shares one with 0.92,
#: one of 0.7 with 0.16, one of 0.6 with 0.01
SPLIT_BANDS = 216
SPLIT_ROWS = 20
#: steps of length, below and above that of a text, in which what it shares is bounded
LENGTH_STEPS = 5


def bags(column: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, shingle) with counts, sorted by both; two 64-bit hashes of each row's whole word sequence."""
    body, offsets = kernel.text_bytes(column, lower=True)
    starts, ends, rows = kernel.words(body, offsets, kernel.WORDISH)
    words = kernel.word_hashes(body, starts, ends)
    items, owner = kernel.shingles(words, rows, width)
    order = np.lexsort((items, owner))
    items, owner = items[order], owner[order]
    count = len(offsets) - 1
    whole = np.zeros((2, count), np.uint64)
    if len(items):
        first = np.flatnonzero(np.r_[True, (items[1:] != items[:-1]) | (owner[1:] != owner[:-1])])
        counts = np.diff(first, append=len(items))
        items, owner = items[first], owner[first]
        heads = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        with np.errstate(over="ignore"):
            place = np.arange(len(words)) - np.repeat(heads, np.diff(heads, append=len(words)))
            for k, salt in enumerate((0x1F123BB5, 0x5851F42D)):
                term = kernel.mixed(words + kernel.mixed(place.astype(np.uint64) + np.uint64(salt)))
                whole[k, rows[heads]] = np.add.reduceat(term, heads)
    else:
        counts = np.zeros(0, np.int64)
    return owner, items, counts, whole[0], whole[1]


def signatures(owner: np.ndarray, items: np.ndarray, counts: np.ndarray, rows: int, registers: int, family: int = 0) -> np.ndarray:
    """Earliest point of every register, rows x registers; infinite for a row without shingles. Families are independent."""
    earliest = np.full(rows * registers, np.inf)
    weight = np.bincount(owner, counts, rows)
    levels = np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1
    source = np.repeat(np.arange(len(items)), levels)
    level = np.arange(len(source)) - np.repeat(np.cumsum(levels) - levels, levels)
    below = np.where(level > 0, np.left_shift(1, np.maximum(level - 1, 0)), 0)  # occurrences before the block
    width = np.where(level > 0, below, 1)
    with np.errstate(over="ignore"):
        seed = kernel.mixed(items[source] + level.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        seed = kernel.mixed(seed ^ np.uint64(family)) if family else seed
    row, limit = owner[source], counts[source]
    todo, horizon = weight > 0, np.zeros(rows)
    horizon[todo] = (math.log(registers) + 2.0) / weight[todo]
    while todo.any():
        live = np.flatnonzero(todo[row])
        state = seed[live]
        moment = np.zeros(len(live))
        rate = width[live] * float(registers)
        while len(live):
            moment = moment - np.log(kernel.uniform(state)) / rate
            near = np.flatnonzero(moment <= horizon[row[live]])
            live, moment, rate, state = live[near], moment[near], rate[near], state[near]
            with np.errstate(over="ignore"):
                draw = kernel.mixed(state ^ np.uint64(0xA0761D6478BD642F))
                state = kernel.mixed(state + np.uint64(0x9E3779B97F4A7C15))
            register = ((draw & np.uint64(0xFFFFFFFF)) % np.uint64(registers)).astype(np.int64)
            occurrence = below[live] + ((draw >> np.uint64(32)) % width[live].astype(np.uint64)).astype(np.int64)
            inside = occurrence < limit[live]
            np.minimum.at(earliest, (row[live] * registers + register)[inside], moment[inside])
        full = np.isfinite(earliest.reshape(rows, registers)).all(axis=1)
        todo &= ~full
        horizon[todo] *= 2.0
    return earliest.reshape(rows, registers)


def _features(docs: DataFrame, width: int, bands: int, per_band: int, family: int = 0) -> DataFrame:
    kind = docs.schema["_id"].dataType
    schema = T.StructType([
        T.StructField("_id", kind), T.StructField("_low", T.LongType()), T.StructField("_high", T.LongType()),
        T.StructField("_size", T.LongType()), T.StructField("_bands", T.ArrayType(T.LongType())),
    ])

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, items, counts, low, high = bags(batch.column("_text"), width)
        n = batch.num_rows
        points = signatures(owner, items, counts, n, bands * per_band, family).view(np.uint64).reshape(n, bands, per_band)
        with np.errstate(over="ignore"):
            key = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
            for k in range(per_band):
                key = kernel.mixed(key + points[:, :, k])
        has = np.bincount(owner, minlength=n) > 0
        return pa.RecordBatch.from_arrays([
            batch.column("_id"), pa.array(low.view(np.int64), mask=~has), pa.array(high.view(np.int64), mask=~has),
            pa.array(np.bincount(owner, counts, n).astype(np.int64)),
            kernel.lists(key[has].reshape(-1).view(np.int64), has * bands, pa.int64()),
        ], names=schema.names)

    return kernel.arrow_map(docs, sign, schema, "_text", 2 << 20)


def overlap(left: pa.Array, right: pa.Array, width: int = WIDTH) -> np.ndarray:
    """Multiset Jaccard similarity of the texts of each row; 0 where one has no word."""
    n = len(left)
    owner_a, items_a, counts_a, _, _ = bags(left, width)
    owner_b, items_b, counts_b, _, _ = bags(right, width)
    total = np.bincount(owner_a, counts_a, n) + np.bincount(owner_b, counts_b, n)
    owner, items = np.concatenate([owner_a, owner_b]), np.concatenate([items_a, items_b])
    counts = np.concatenate([counts_a, counts_b])
    order = np.lexsort((items, owner))
    owner, items, counts = owner[order], items[order], counts[order]
    same = np.flatnonzero((owner[1:] == owner[:-1]) & (items[1:] == items[:-1]))
    shared = np.bincount(owner[same], np.minimum(counts[same], counts[same + 1]), n)
    return shared / np.maximum(total - shared, 1)


def _verified(pairs: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """Links (a, b) that connect what ``pairs`` (member, leader, left, right) connect whose texts reach ``similarity``.

    ``left`` and ``right`` are the components that member and leader are known to belong to; links are between those.
    Pairs are dealt by member at last, so a task sees all leaders of a member: it links the member with the least of
    them, and each of them with the next, which gives the same few links wherever leaders are met again.
    """
    kind = pairs.schema["member"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    sized = texts.select("_id", "_text", "_size")
    both = (
        pairs.distinct().join(sized.select(F.col("_id").alias("leader"), F.col("_text").alias("_right"), F.col("_size").alias("_n")), "leader")
        .join(sized.select(F.col("_id").alias("member"), F.col("_text").alias("_left"), F.col("_size").alias("_m")), "member")
        # bags of such different sizes cannot be that similar
        .where(F.least("_m", "_n") >= F.greatest("_m", "_n") * (similarity - 1e-9))
        .select("left", "right", "_left", "_right")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good = []
        for wide in batches:
            for part in kernel.slices([wide], "_right", 1 << 18):
                for batch in kernel.slices([part], "_left", 1 << 18):
                    same = overlap(batch.column("_left"), batch.column("_right"), width) >= similarity
                    good.append(batch.select(["left", "right"]).filter(pa.array(same)))
        if not good or not sum(g.num_rows for g in good):
            return
        links = pa.Table.from_batches(good).combine_chunks()
        ends = pa.concat_arrays([links.column(k).chunk(0) for k in range(2)])
        coded = ends.dictionary_encode()
        # numbered by size, so that "least" means the same in every task
        order = pc.array_sort_indices(coded.dictionary)
        ids, number = coded.dictionary.take(order), np.empty(len(order), np.int64)
        number[order.to_numpy()] = np.arange(len(order))
        code = number[coded.indices.to_numpy()]
        member, leader = np.unique(np.stack([code[: links.num_rows], code[links.num_rows :]]), axis=1)
        again = np.r_[False, member[1:] == member[:-1]]
        chained = np.unique(np.stack([np.where(again, np.r_[0, leader[:-1]], member), leader]), axis=1)
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(chained[0])), ids.take(pa.array(chained[1]))], names=["a", "b"])

    return both.mapInArrow(verify, schema)


def _mixed(placed: DataFrame) -> DataFrame:
    """The texts (_id, component) of the buckets that hold several components."""
    mixed = placed.groupBy("_bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(F.col("low") < F.col("high"))
    return placed.join(mixed.select("_bucket"), "_bucket", "left_semi").groupBy("_id").agg(F.first("component").alias("component"))


def _linkable(texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """The ids of ``texts`` (_id, component, _text) without those that can reach ``similarity`` with no text of another component.

    A text of n shingles and one of m share s / (1 + s) * (n + m) of them at least, and m lies between s * n and n / s. What a
    text has in common with any text of m shingles occurs in several components and in a text no longer than m, so
    the sum of such shingles bounds it; m is tried in steps. No pair that reaches the similarity is lost.
    """
    kind = texts.schema["_id"].dataType
    schema = T.StructType([
        T.StructField("_id", kind), T.StructField("component", kind), T.StructField("_size", T.LongType()),
        T.StructField("_item", T.LongType()), T.StructField("_times", T.LongType()),
    ])

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, items, counts, _, _ = bags(batch.column("_text"), width)
        size = np.bincount(owner, counts, batch.num_rows).astype(np.int64)
        of = pa.array(owner)
        return pa.RecordBatch.from_arrays([
            batch.column("_id").take(of), batch.column("component").take(of), pa.array(size[owner]),
            pa.array(items.view(np.int64)), pa.array(np.asarray(counts, np.int64)),
        ], names=schema.names)

    items = settled(kernel.arrow_map(texts, spread, schema, "_text"), "shingles")
    common = items.groupBy("_item").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("_size").alias("_least")
    ).where(F.col("low") < F.col("high")).select("_item", "_least")
    edges = [similarity ** (1 - k / LENGTH_STEPS) for k in range(2 * LENGTH_STEPS + 1)]
    # the last step takes its upper edge
    ends = [*edges[1:-1], edges[-1] * (1 + 1e-9)]
    reach = items.join(common, "_item").groupBy("_id").agg(
        F.first("_size").alias("_size"),
        *[F.sum(F.when(F.col("_least") < F.col("_size") * end, F.col("_times"))).alias(f"r{k}") for k, end in enumerate(ends)],
    )
    share = similarity / (1 + similarity) * (1 - 1e-9)
    able = [F.col(f"r{k}") >= F.col("_size") * ((1 + edge) * share) for k, edge in enumerate(edges[:-1])]
    return reach.where(F.greatest(*[F.coalesce(a, F.lit(False)) for a in able])).select("_id")


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH, bands: int = BANDS, per_band: int = ROWS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, class_id (smallest id of its near-duplicate component), kept (is that id).

    Words are runs of letters, digits and underscores, case folded; texts with equal words are one
    class, other texts are linked where their bags of ``width``-word shingles have a Jaccard
    similarity of ``similarity`` or more (a text with fewer words is one shingle). Null texts and texts
    without words are linked with nothing. Rows with equal ids are one document. A row with a null
    id is its own class with a null class_id and kept. Only id and text are read; an empty table
    gives no rows.
    """
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = settled(_features(source, width, bands, per_band), "bags")
    known = found.where(F.col("_id").isNotNull() & F.col("_low").isNotNull())
    classes = known.groupBy("_low", "_high").agg(F.min("_id").alias("_class"))
    copies = settled(
        known.join(classes, ["_low", "_high"]).select(
            "_id", "_class", "_size", F.when(F.col("_id") == F.col("_class"), F.col("_bands")).alias("_bands")
        ), "copies",
    )
    members = copies.where(F.col("_bands").isNotNull()).select("_id", "_size", F.explode("_bands").alias("_bucket"))
    crowded = members.groupBy("_bucket").agg(F.count("*").alias("n"), F.min_by("_id", F.xxhash64("_id", F.lit(0))).alias("_leader"))
    members = settled(members.join(crowded.where(F.col("n") > 1), "_bucket").select("_bucket", "_id", "_size", "_leader"), "buckets")
    texts = settled(source.join(members.groupBy("_id").agg(F.max("_size").alias("_size")), "_id").dropDuplicates(["_id"]), "texts")
    pairs = members.where(F.col("_id") != F.col("_leader")).select(
        F.col("_id").alias("member"), F.col("_leader").alias("leader"), F.col("_id").alias("left"), F.col("_leader").alias("right")
    )
    links = settled(_verified(pairs, texts, width, similarity).distinct(), "verified")
    for turn in range(1, LEADER_ROUNDS + 1):
        # labels need not be final here: texts that are connected but labelled apart are compared once more
        placed = _placed(members.select("_bucket", "_id"), links)
        # the leader of a bucket that still holds texts of several components
        lead = placed.groupBy("_bucket").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.min_by(F.struct("_id", "component"), F.xxhash64("_id", F.lit(turn))).alias("lead"),
        ).where(F.col("low") < F.col("high"))
        apart = placed.join(lead.select("_bucket", "lead"), "_bucket").where(F.col("component") != F.col("lead.component"))
        pairs = apart.select(
            F.col("_id").alias("member"), F.col("lead._id").alias("leader"), F.col("component").alias("left"), F.col("lead.component").alias("right")
        )
        more = settled(_verified(pairs, texts, width, similarity).union(links).distinct(), "verified")
        release(placed, links)
        links = more
    # what is still apart within a bucket meets again in longer bands of further registers, without the texts that share too little
    placed = _placed(members.select("_bucket", "_id"), links)
    apart = texts.join(_mixed(placed), "_id").select("_id", "component", "_text")
    linkable = settled(_linkable(apart, width, similarity), "linkable")
    open_ = settled(_mixed(placed.join(linkable, "_id", "left_semi")), "open")
    again = _features(texts.join(open_, "_id", "left_semi").select("_id", "_text"), width, SPLIT_BANDS, SPLIT_ROWS, family=1)
    split = settled(again.select("_id", F.explode("_bands").alias("_bucket")).join(open_, "_id"), "split")
    crowded = split.groupBy("_bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(F.col("low") < F.col("high"))
    several = split.join(crowded.select("_bucket"), "_bucket", "left_semi")
    left = several.select("_bucket", F.col("_id").alias("member"), F.col("component").alias("left"))
    right = several.select("_bucket", F.col("_id").alias("leader"), F.col("component").alias("right"))
    pairs = left.join(right, "_bucket").where((F.col("member") > F.col("leader")) & (F.col("left") != F.col("right"))).drop("_bucket")
    more = settled(_verified(pairs, texts, width, similarity).union(links).distinct(), "verified")
    release(placed, links, linkable, open_, split)
    final = components(more).withColumnRenamed("node", "_class")
    placed = copies.select("_id", "_class").distinct().join(final, "_class", "left").select(
        "_id", F.coalesce("component", "_class").alias("class_id")
    )
    merged = placed.groupBy("_id").agg(F.min("class_id").alias("class_id"))
    out = found.select("_id").join(merged, "_id", "left").withColumn("class_id", F.coalesce("class_id", "_id"))
    release(members, texts, more)
    return out.select(
        F.col("_id").alias(id_col), "class_id", F.coalesce(F.col("_id") == F.col("class_id"), F.lit(True)).alias("kept")
    )


def _placed(members: DataFrame, links: DataFrame) -> DataFrame:
    """Each bucket's texts with the component they are known to belong to."""
    labels = components(links, LABEL_ROUNDS).withColumnRenamed("node", "_id")
    placed = settled(members.join(labels, "_id", "left").withColumn("component", F.coalesce("component", "_id")), "placed")
    return placed
