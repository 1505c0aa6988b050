"""Benchmark decontamination: BM25 over an inverted index of test items, searched by block-max WAND.

Every training passage is a query. Contributions are divided by the item's score for its own text, so
one threshold holds for all items and list maxima are comparable. The weakest terms of an item, which
together give less than half of the threshold, cannot make it a hit; a passage whose other terms do not
reach the rest for any item has no pivot. That first test is made for all passages of a slice at once,
and the others run the document-at-a-time loop with block maxima. Items found are verified: the word
n-grams of question and of answer must both stand in the passage.

The index is cut into shards of about ``SHARD_BYTES`` of item text, each searched by a scan of the
documents. Only a shard travels to the tasks.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazemart.llm import kernel

K1, B = 1.2, 0.75
THRESHOLD = 0.5
OVERLAP = 0.6
GRAM = 5
WINDOW = 128
BLOCK = 32
SHARD_BYTES = 4 << 20
FILTER_BITS = 20


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: the last line, or else the last sentence, is the answer; a single sentence has none."""
    text = text.strip()
    head, line, tail = text.rpartition("\n")
    if line and head.strip() and tail.strip():
        return head, tail
    ends = [m.end() for m in re.finditer(r"[.?!]\s+", text)]
    return (text[: ends[-1]], text[ends[-1] :]) if ends else (text, "")


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    body, offsets = kernel.text_bytes(pa.array(texts, pa.string()), lower=True)
    starts, ends, rows = kernel.words(body, offsets, kernel.WORDISH)
    return kernel.word_hashes(body, starts, ends), rows


@dataclass
class Index:
    """Postings of one shard, term by term in ``vocabulary`` order; items are numbered within the shard."""

    ids: list
    vocabulary: np.ndarray
    known: np.ndarray
    bounds: np.ndarray
    items: np.ndarray
    impacts: np.ndarray
    peak: np.ndarray
    block_peak: list
    strong_bounds: np.ndarray
    strong_items: np.ndarray
    strong_impacts: np.ndarray
    weak: np.ndarray
    parts: list
    window: int
    opened: dict = field(default_factory=dict)

    def postings(self, term: int) -> tuple[list, list, float, list]:
        if term not in self.opened:
            a, b = self.bounds[term : term + 2]
            self.opened[term] = (
                self.items[a:b].tolist(), self.impacts[a:b].tolist(), float(self.peak[term]), self.block_peak[term].tolist()
            )
        return self.opened[term]

    def search(self, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """All items with a score of ``threshold`` or more for a set of terms, by block-max WAND."""
        lists = [self.postings(int(t)) for t in terms]
        heap = [(items[0], k) for k, (items, *_) in enumerate(lists)]
        heapq.heapify(heap)
        place = [0] * len(lists)
        found = []

        def forward(k: int, target: int) -> None:
            items = lists[k][0]
            place[k] = bisect_left(items, target, place[k])
            if place[k] < len(items):
                heapq.heappush(heap, (items[place[k]], k))

        while heap:
            total, taken, pivot = 0.0, [], None
            while heap:
                item, k = heap[0]
                if pivot is not None and item != pivot:
                    break
                heapq.heappop(heap)
                taken.append(k)
                total += lists[k][2]
                if pivot is None and total >= threshold:
                    pivot = item
            if pivot is None:
                break
            # maxima of the blocks that could hold the pivot
            near, edge = 0.0, None
            for k in taken:
                items, _, _, peaks = lists[k]
                at = bisect_left(items, pivot, place[k])
                if at < len(items):
                    near += peaks[at // BLOCK]
                    last = items[min(len(items), (at // BLOCK + 1) * BLOCK) - 1] + 1
                    edge = last if edge is None else min(edge, last)
            if near < threshold:
                target = max(pivot + 1, edge if edge is not None else pivot + 1)
                if heap:
                    target = min(target, max(pivot + 1, heap[0][0]))
                for k in taken:
                    forward(k, target)
                continue
            score = 0.0
            for k in taken:
                items, impacts, _, _ = lists[k]
                at = bisect_left(items, pivot, place[k])
                if at < len(items) and items[at] == pivot:
                    score += impacts[at]
                place[k] = at
                forward(k, pivot + 1)
            if score >= threshold:
                found.append((pivot, score))
        return found


def build_index(
    rows: list[tuple[object, str]], frequency: dict[int, int], count: int, average: float, threshold: float = THRESHOLD
) -> Index:
    """Postings of one shard; ``frequency`` (of word hashes), ``count`` and ``average`` describe all items."""
    hashes, owner = _words([text for _, text in rows])
    lengths = np.bincount(owner, minlength=len(rows))
    vocabulary = np.unique(hashes)
    pairs, tf = np.unique(np.searchsorted(vocabulary, hashes) * len(rows) + owner, return_counts=True)
    term, item = pairs // max(1, len(rows)), pairs % max(1, len(rows))
    df = np.array([frequency[int(h)] for h in vocabulary], np.float64)
    idf = np.log1p((count - df + 0.5) / (df + 0.5))
    impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[item] / max(average, 1e-9)))
    own = np.bincount(item, impact, minlength=len(rows))
    impact = impact / own[item]
    bounds = np.searchsorted(term, np.arange(len(vocabulary) + 1))
    peaks = [np.maximum.reduceat(impact[a:b], np.arange(0, b - a, BLOCK)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    # the weakest terms of each item, while together below half of the threshold
    order = np.lexsort((impact, item))
    running = np.cumsum(impact[order])
    heads = np.searchsorted(item[order], np.arange(len(rows)))
    running -= np.r_[0.0, running][heads][item[order]]
    strong = np.ones(len(item), bool)
    strong[order] = running >= threshold / 2
    weak = np.bincount(item[~strong], impact[~strong], minlength=len(rows))
    known = np.zeros(1 << FILTER_BITS, bool)
    known[(vocabulary >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    parts = []
    for _, text in rows:
        sides = []
        for side in split_item(text):
            words, _ = _words([side])
            width = min(GRAM, len(words))
            grams = kernel.shingles(words, np.zeros(len(words), np.int64), width)[0] if width else np.zeros(0, np.uint64)
            sides.append((width, np.unique(grams)))
        parts.append(sides)
    return Index(
        [i for i, _ in rows], vocabulary, known, bounds, item, impact,
        np.array([p.max() for p in peaks]), peaks,
        np.searchsorted(term[strong], np.arange(len(vocabulary) + 1)), item[strong], impact[strong], weak, parts, max(WINDOW, 2 * int(lengths.max(initial=0))),
    )


def _overlaps(words: np.ndarray, sides: list) -> list[float]:
    shares = []
    for width, grams in sides:
        if not width:
            shares.append(1.0)
            continue
        there = kernel.shingles(words, np.zeros(len(words), np.int64), width)[0]
        shares.append(float(np.isin(grams, there).mean()))
    return shares


def _hits(index: Index, column: pa.Array, threshold: float, overlap: float) -> list[tuple[int, int, int, float, float, float]]:
    """(row, item, first word of the passage, score, question overlap, answer overlap), the best passage of each item."""
    body, offsets = kernel.text_bytes(column, lower=True)
    starts, ends, rows = kernel.words(body, offsets, kernel.WORDISH)
    hashes = kernel.word_hashes(body, starts, ends)
    maybe = np.flatnonzero(index.known[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    term = np.minimum(np.searchsorted(index.vocabulary, hashes[maybe]), len(index.vocabulary) - 1)
    real = index.vocabulary[term] == hashes[maybe]
    maybe, term = maybe[real], term[real]
    if not len(maybe):
        return []
    # a passage is two neighbouring slots of half a window; slots are numbered through all rows
    first_word = np.searchsorted(rows, np.arange(len(offsets)))
    stride = index.window // 2
    slots = np.maximum(1, -(-np.diff(first_word) // stride))
    base = np.cumsum(slots) - slots
    row = rows[maybe]
    n_terms, n_items = len(index.vocabulary), len(index.ids)
    key = np.unique((base[row] + (maybe - first_word[row]) // stride) * n_terms + term)
    where, what = key // n_terms, key % n_terms
    lists = np.diff(index.strong_bounds)[what]
    total = int(lists.sum())
    at = np.repeat(index.strong_bounds[what] - (np.cumsum(lists) - lists), lists) + np.arange(total)
    pairs, inverse = np.unique(np.repeat(where, lists) * n_items + index.strong_items[at], return_inverse=True)
    if not len(pairs):
        return []
    sums = np.bincount(inverse, index.strong_impacts[at])
    following = np.minimum(np.searchsorted(pairs, pairs + n_items), len(pairs) - 1)
    bound = sums + np.where(pairs[following] == pairs + n_items, sums[following], 0.0) + index.weak[pairs % n_items]
    promising = pairs[bound >= threshold - 1e-9] // n_items
    # a passage also begins one slot before what is only in its second slot
    promising = np.unique(np.concatenate([promising, np.maximum(promising - 1, 0)]))
    best: dict[tuple[int, int], tuple] = {}
    for passage in promising:
        owner = int(np.searchsorted(base, passage, side="right") - 1)
        low, high = np.searchsorted(where, [passage, min(passage + 2, base[owner] + slots[owner])])
        begin = int(first_word[owner] + (passage - base[owner]) * stride)
        stop = min(int(first_word[owner + 1]), begin + index.window)
        for item, score in index.search(np.unique(what[low:high]), threshold):
            question, answer = _overlaps(hashes[begin:stop], index.parts[item])
            if question >= overlap and answer >= overlap:
                hit = (owner, item, begin - int(first_word[owner]), score, question, answer)
                if (owner, item) not in best or best[owner, item][3] < score:
                    best[owner, item] = hit
    return list(best.values())


def contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per document row and test item it holds: id, item_id, first_word, score, question_overlap, answer_overlap.

    Passages are windows of at least 128 words and twice the longest item, overlapping by half. A hit
    needs a BM25 score of ``threshold`` of the item's own and at least ``overlap`` of the word 5-grams
    of both its question and its answer (shorter ones: the whole). Case and punctuation do not count.
    Null or empty texts and items without words give no hits; items with null ids are searched and
    reported with a null item_id; repeated rows are reported each. Only ids and texts are read; an empty table on
    either side gives no rows. The passage with the highest score is reported, the earliest among equals.
    """
    spark = docs.sparkSession
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("item_id", items.schema[item_col].dataType),
        T.StructField("first_word", T.LongType()), T.StructField("score", T.DoubleType()),
        T.StructField("question_overlap", T.DoubleType()), T.StructField("answer_overlap", T.DoubleType()),
    ])
    source = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    wanted = items.select(F.col(item_col).alias("id"), F.col(item_text_col).alias("text")).where(F.col("text").isNotNull())
    size, count = wanted.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    shards = max(1, -(-(size or 0) // SHARD_BYTES))
    statistics = _term_statistics(wanted)
    n_words, n_items = statistics.where(F.col("term").isNull()).agg(F.sum("n_words"), F.sum("n_items")).first()
    out = spark.createDataFrame([], schema)
    for shard in range(shards if n_items else 0):
        own = wanted.where(F.pmod(F.xxhash64("text"), F.lit(shards)) == shard)
        rows = [(r["id"], r["text"]) for r in own.collect() if len(_words([r["text"]])[0])]
        if not rows:
            continue
        terms = _term_statistics(own).where(F.col("term").isNotNull()).select("term").distinct()
        counted = statistics.join(terms, "term", "left_semi").groupBy("term").agg(F.sum("n_items")).collect()
        frequency = {t % (1 << 64): n for t, n in counted}
        shared = spark.sparkContext.broadcast(build_index(rows, frequency, n_items, n_words / n_items, threshold))

        def search(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch | None:
            found = _hits(shared.value, batch.column("_text"), threshold, overlap)
            if not found:
                return None
            ids = [shared.value.ids[h[1]] for h in found]
            columns = [batch.column(0).take(pa.array([h[0] for h in found]))]
            kinds = (None, pa.int64(), pa.float64(), pa.float64(), pa.float64())
            for value, kind in zip((ids, *([h[k] for h in found] for k in (2, 3, 4, 5))), kinds, strict=True):
                columns.append(pa.array(value, kind if kind is not None else _arrow(schema["item_id"].dataType)))
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        out = out.union(kernel.arrow_map(source, search, schema, "_text"))
    return out


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _term_statistics(items: DataFrame) -> DataFrame:
    """Per task and term the number of items; rows with a null term count items and words."""
    schema = T.StructType([
        T.StructField("term", T.LongType()), T.StructField("n_items", T.LongType()), T.StructField("n_words", T.LongType()),
    ])

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, owner = _words(batch.column("text").to_pylist())
        pairs = np.unique(np.stack([hashes, owner.astype(np.uint64)]), axis=1)
        terms, n = np.unique(pairs[0], return_counts=True)
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([pa.array(terms.view(np.int64)), pa.nulls(1, pa.int64())]),
            pa.array([*n.tolist(), len(np.unique(owner))], pa.int64()),
            pa.array([*np.zeros(len(n), np.int64).tolist(), len(hashes)], pa.int64()),
        ], names=schema.names)

    return kernel.arrow_map(items, count, schema, "text")
