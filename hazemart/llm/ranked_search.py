"""Ranked lexical search over a length-stratified index.

A document's length enters its score only through the normaliser m = 50 + 50 n N div L, so documents
with equal m form a stratum in which the impact of a term depends on its frequency alone: it is
computed once for each frequency of the stratum. The index is a table with one row per document,
sorted by length within its files; a task reads it in blocks, lays each block out by stratum and
term, and bounds every item's score in every stratum by the largest impacts there. Strata are visited
in the order of their bounds until none can reach the item's present last place. Every task hands on
the best of its own documents, and the best of all are taken from those.

Scores are integers below 2**53, so products and sums in doubles are exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from hazemart.llm import kernel
from hazemart.session import settled

#: item text whose terms and weights one scan of the index serves; they are broadcast
SHARD_BYTES = 8 << 20
#: documents laid out at a time, items and strata bounded at a time
BLOCK = 2048
ITEMS = 256
STRATA = 512
#: strata visited before the bounds are compared with the last place again
FIRST_VISITS = 8
#: a text is cut into pieces of this size at separators while its terms are counted
PIECE_BYTES = 1 << 20

# bytes of terms: digits, letters and all of characters beyond ASCII; A-Z becomes a-z, the rest a space
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def term_counts(text: bytes) -> Counter:
    """How often each term stands in a UTF-8 text."""
    body, counts, low = text.translate(_TERM_BYTES), Counter(), 0
    while low < len(body):
        high = body.find(b" ", low + PIECE_BYTES)
        high = len(body) if high < 0 else high
        counts.update(body[low:high].split())
        low = high + 1
    return counts


def weight(documents: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


def normaliser(length: int, documents: int, total: int) -> int:
    return 100 - 50 + (50 * length * documents) // total


def impact(frequency: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * frequency) // (1000 * frequency + 20 * m)


def index_documents(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(_id, n, terms, tfs) of every row with a term, sorted by length within its files.

    ``n`` counts all terms of the whole text; postings hold those of ``terms``, by number.
    """
    kind = docs.schema["_id"].dataType
    schema = T.StructType([
        T.StructField("_id", kind), T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.LongType())),
    ])
    shared = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(terms)})

    def post(batch: pa.RecordBatch) -> pa.RecordBatch:
        number = shared.value
        lengths, sizes, found, often = [], [], [], []
        for text in batch.column("_text").cast(pa.large_binary()).to_pylist():
            counts = term_counts(text) if text else Counter()
            lengths.append(sum(counts.values()))
            before = len(found)
            for term, tf in counts.items():
                place = number.get(term)
                if place is not None:
                    found.append(place)
                    often.append(tf)
            sizes.append(len(found) - before)
        sizes = np.array(sizes, np.int64)
        out = pa.RecordBatch.from_arrays([
            batch.column("_id"), pa.array(lengths, pa.int64()),
            pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(found, pa.int32())),
            pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(often, pa.int64())),
        ], names=schema.names)
        return out.filter(pa.array(np.array(lengths) > 0))

    return settled(kernel.arrow_map(docs, post, schema, "_text").sortWithinPartitions("n"), "strata")


class Items:
    """The items' terms with their weights, in groups that are bounded together."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray, top: int):
        self.terms, self.weights, self.top = terms, weights, top
        self.groups = []
        for low in range(0, len(terms), ITEMS):
            members = range(low, min(low + ITEMS, len(terms)))
            used = np.unique(np.concatenate([terms[i] for i in members]))
            table = np.zeros((len(members), len(used)))
            for row, i in enumerate(members):
                table[row, np.searchsorted(used, terms[i])] = weights[terms[i]]
            self.groups.append((members, used, table))


class Best:
    """The ``top`` documents of one item so far: higher score first, then smaller id, null ids last."""

    def __init__(self, top: int):
        self.top, self.rows, self.floor = top, [], 0

    def offer(self, scores: np.ndarray, ids: list) -> None:
        if len(scores) > self.top:
            last = np.partition(scores, len(scores) - self.top)[len(scores) - self.top]
            picked = np.flatnonzero(scores >= last)
        else:
            picked = np.arange(len(scores))
        self.rows += [(-int(scores[k]), ids[k] is None, ids[k] if ids[k] is not None else 0) for k in picked]
        self.rows = sorted(self.rows)[: self.top]
        if len(self.rows) == self.top:
            self.floor = -self.rows[-1][0]


class Block:
    """Postings of some documents by term and stratum, with one impact for each frequency of a stratum."""

    def __init__(self, batch: pa.RecordBatch, documents: int, total: int):
        n = batch.column("n").to_numpy(zero_copy_only=False)
        lengths, which = np.unique(n, return_inverse=True)
        m = np.array([normaliser(int(x), documents, total) for x in lengths], np.int64)[which]
        self.m, stratum = np.unique(m, return_inverse=True)
        self.ids = batch.column("_id")
        sizes = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False)
        terms = batch.column("terms").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        tfs = batch.column("tfs").flatten().to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((stratum[doc], terms))
        self.term, self.doc, tfs = terms[order], doc[order], tfs[order]
        self.stratum = stratum[self.doc]
        width = int(tfs.max()) + 1 if len(tfs) else 1
        kinds, kind = np.unique(self.stratum * width + tfs, return_inverse=True)
        self.impact = impact(kinds % width, self.m[kinds // width])[kind].astype(np.float64)
        self.start = np.flatnonzero(np.r_[True, self.term[1:] != self.term[:-1]]) if len(doc) else np.zeros(0, np.int64)
        self.stop = np.r_[self.start[1:], len(doc)] if len(doc) else self.start
        self.held = self.term[self.start]
        cell = np.flatnonzero(np.r_[True, (self.term[1:] != self.term[:-1]) | (self.stratum[1:] != self.stratum[:-1])]) if len(doc) else self.start
        self.cell_term, self.cell_stratum = self.term[cell], self.stratum[cell]
        self.cell_impact = np.maximum.reduceat(self.impact, cell) if len(doc) else np.zeros(0)

    def bounds(self, used: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Items x strata: no document of the stratum scores more."""
        out = np.zeros((len(table), len(self.m)))
        here = np.isin(used, self.held, assume_unique=True)
        used, table = used[here], table[:, here]
        place = np.searchsorted(used, self.cell_term)
        place[place == len(used)] = 0
        mine = used[place] == self.cell_term if len(used) else np.zeros(len(place), bool)
        for low in range(0, len(self.m), STRATA):
            high = min(low + STRATA, len(self.m))
            part = mine & (self.cell_stratum >= low) & (self.cell_stratum < high)
            largest = np.zeros((len(used), high - low))
            largest[place[part], self.cell_stratum[part] - low] = self.cell_impact[part]
            out[:, low:high] = table @ largest
        return out

    def visit(self, terms: np.ndarray, weights: np.ndarray, strata: np.ndarray, best: Best) -> None:
        """Scores the documents of the marked ``strata`` for one item."""
        at = np.searchsorted(self.held, terms)
        known = np.flatnonzero((at < len(self.held)) & (self.held[np.minimum(at, len(self.held) - 1)] == terms))
        start, size = self.start[at[known]], (self.stop - self.start)[at[known]]
        posting = np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)
        factor = np.repeat(weights[terms[known]], size)
        open_ = strata[self.stratum[posting]]
        posting, factor = posting[open_], factor[open_]
        scores = np.bincount(self.doc[posting], factor * self.impact[posting], len(self.ids))
        found = np.flatnonzero((scores > 0) & (scores >= best.floor))
        if len(found):
            best.offer(scores[found], self.ids.take(pa.array(found)).to_pylist())

    def search(self, items: Items, best: list[Best]) -> None:
        if not len(self.held):
            return
        for members, used, table in items.groups:
            bounds = self.bounds(used, table)
            floors = np.array([best[i].floor for i in members])[:, None]
            for row in np.flatnonzero(((bounds > 0) & (bounds >= floors)).any(axis=1)):
                i, bound = members[row], bounds[row]
                order = np.argsort(-bound, kind="stable")
                for some in (order[:FIRST_VISITS], order[FIRST_VISITS:]):
                    marked = np.zeros(len(bound), bool)
                    marked[some[(bound[some] > 0) & (bound[some] >= best[i].floor)]] = True
                    if marked.any():
                        self.visit(items.terms[i], items.weights, marked, best[i])


def _searched(index: DataFrame, items: Items, documents: int, total: int) -> DataFrame:
    """(item, _id, score): the best of every task for every item."""
    kind = index.schema["_id"].dataType
    schema = T.StructType([
        T.StructField("item", T.IntegerType()), T.StructField("_id", kind), T.StructField("score", T.LongType()),
    ])
    shared = index.sparkSession.sparkContext.broadcast(items)
    id_type = to_arrow_type(kind)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        best = [Best(items.top) for _ in items.terms]
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                Block(batch.slice(low, BLOCK), documents, total).search(items, best)
        rows = [(i, None if row[1] else row[2], -row[0]) for i, b in enumerate(best) for row in b.rows]
        if rows:
            item, found, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array(found, id_type), pa.array(score, pa.int64())], names=schema.names
            )

    return index.mapInArrow(search, schema)


def ranked(
    docs: DataFrame, items: DataFrame, top: int = 50,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The ``top`` documents of every item: item_id, rank (from 1), doc id, score (long, above 0).

    Terms are maximal runs of ASCII letters, digits and characters beyond ASCII; A-Z is lower-cased.
    Equal scores rank by ascending id, null ids last. Items with one id (or null ids) are one item with
    the terms of all their texts. Null and empty texts have no terms: such a document is not counted, such
    an item has no rows. Repeated document rows are documents each. Only ids and texts are read; an
    empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    wanted = items.select(F.col(item_col).alias("id"), F.col(item_text_col).alias("text")).where(F.col("text").isNotNull())
    size = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    schema = T.StructType([
        T.StructField("item_id", items.schema[item_col].dataType), T.StructField("rank", T.IntegerType()),
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.LongType()),
    ])
    out = spark.createDataFrame([], schema)
    for shard in range(shards):
        texts: dict = {}
        for row in wanted.where(F.pmod(F.xxhash64("id"), F.lit(shards)) == shard).collect():
            texts.setdefault(row["id"], set()).update(term_counts(row["text"].encode()))
        texts = {i: t for i, t in texts.items() if t}
        if not texts:
            continue
        vocabulary = sorted(set().union(*texts.values()))
        number = {t: k for k, t in enumerate(vocabulary)}
        index = index_documents(source, vocabulary)
        documents, total = index.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            continue
        held = index.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        weights = np.zeros(len(vocabulary))
        for term, holders in held:
            weights[term] = weight(documents, holders)
        terms = [np.array(sorted(number[t] for t in own), np.int64) for own in texts.values()]
        limit = max(len(t) for t in terms) * weights.max() * 1_000_000
        if limit >= 1 << 53:
            raise ValueError(f"an item with {max(map(len, terms))} terms could pass the exact range of doubles")
        names = spark.createDataFrame(list(enumerate(texts)), T.StructType([
            T.StructField("item", T.IntegerType()), T.StructField("item_id", schema["item_id"].dataType),
        ]))
        place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("_id"))
        best = _searched(index, Items(terms, weights, top), documents, total).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
        out = out.union(best.join(names, "item").select("item_id", "rank", F.col("_id").alias(id_col), "score"))
    return out
