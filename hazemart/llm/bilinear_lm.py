"""Text probabilities by a log-bilinear model over words in a tree of classes, trained with noise-contrastive estimation.

A unit is one of the ``LEXICON`` most frequent tokens, the rare tokens of one shape (the hash of the last
two bytes), or the end of text. Every unit has an input vector of its own: the vectors of the two units
before, each moved by the matrix of its position, are added. The next unit is predicted in three steps
with output vectors of their own: its class (the most frequent tokens by themselves, the rest by shape,
the end), its group of about ``GROUP`` units within the class, and the unit within the group. Each step
is normalised over what it chooses from, and a rare token has its share of the rare tokens' counts, so
probabilities of tokens add up to one.

A model of the classes alone, fitted in numpy on class trigram counts, is where training starts. The
documents are then dealt by a hash of id and content into parts of about ``PART_TOKENS`` tokens. Each
part is taken in the order of the ids, each occurrence one example, so steps grow with the corpus; the
changes are averaged by unit, weighted by how often a part trained it, and added in the order of the
parts. So the weights are a property of the corpus and not of how Spark cuts the input.

Texts are cut into tokens twice: to count them, and to write them as unit numbers once the lexicon is
known; the trigram counts, training and scoring read those. Weights and counts of the units travel to
the tasks; rare tokens meet their counts in a join by token, in which no token is frequent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazemart.llm import kernel
from hazemart.session import settled

OWN_CLASSES = 79
SHAPES = 32
CLASSES = OWN_CLASSES + SHAPES + 1
END_CLASS = CLASSES - 1
LEXICON = 1 << 17
WIDTH = 24
NOISE = 48
BATCH = 2048
STEPS = 1500
RATE = 0.1
#: the code of the end of a text; words have other codes with all but certainty
END = np.uint64(0x5DEECE66D2B79F1B)
COUNT_BYTES = 2 << 20
GROUP = 64
#: tokens of a part of the training stream, and tokens that are mixed with each other within it
PART_TOKENS = 8 << 20
MIXED_TOKENS = 1 << 18
#: examples of a step in a part, noise of a step for each of class, group and unit, first step width
STREAM_BATCH = 2048
STREAM_NOISE = (32, 32, 64)
STREAM_RATE = 0.1
#: units whose changes travel as one row
BLOCK = 256
#: runs of rows up to this are added step by step
SHORT_RUN = 8
#: rows of hidden units that a scoring task holds at a time
HELD_ROWS = 1 << 16
#: high bits by which a token is looked up in the lexicon
SLOT_BITS = 18


@dataclass
class Weights:
    vectors: np.ndarray
    positions: np.ndarray
    outputs: np.ndarray
    bias: np.ndarray

    def log_probabilities(self) -> np.ndarray:
        """Normalised natural logarithms by (class two back, class one back, class)."""
        back = [self.vectors @ p for p in self.positions]
        out = np.empty((CLASSES, CLASSES, CLASSES))
        for c in range(CLASSES):
            scores = (back[0][c] + back[1]) @ self.outputs.T + self.bias
            scores -= scores.max(axis=1, keepdims=True)
            out[c] = scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))
        return out


def _summed(classes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the rows of each class, as a product with their indicator."""
    indicator = np.zeros((CLASSES, len(classes)))
    indicator[classes, np.arange(len(classes))] = 1.0
    return indicator @ rows


def train(cells: np.ndarray, counts: np.ndarray, seed: int = 3) -> Weights:
    """Weights from trigram counts; a cell is (two back * CLASSES + one back) * CLASSES + class."""
    random = np.random.default_rng(seed)
    small = lambda *shape: random.normal(0, 0.1, shape)
    model = Weights(small(CLASSES, WIDTH), np.stack([np.eye(WIDTH) * 0.5, np.eye(WIDTH)]), small(CLASSES, WIDTH), np.zeros(CLASSES))
    if not len(cells):
        return model
    unigram = np.bincount(cells % CLASSES, counts, CLASSES) + 0.5
    unigram /= unigram.sum()
    model.bias = np.log(unigram)
    running = np.cumsum(counts, dtype=np.float64)
    noise_running = np.cumsum(unigram)
    squares = [np.full_like(x, 1e-2) for x in (model.vectors, model.positions, model.outputs, model.bias)]
    log_noise = np.log(NOISE * unigram)
    for step in range(STEPS):
        drawn = cells[np.minimum(np.searchsorted(running, random.random(BATCH) * running[-1]), len(cells) - 1)]
        target, context = drawn % CLASSES, (drawn // CLASSES**2, drawn // CLASSES % CLASSES)
        noise = np.minimum(np.searchsorted(noise_running, random.random(NOISE)), CLASSES - 1)
        inputs = [model.vectors[c] for c in context]
        hidden = sum(x @ p for x, p in zip(inputs, model.positions, strict=True))
        good = np.einsum("ij,ij->i", hidden, model.outputs[target]) + model.bias[target] - log_noise[target]
        bad = hidden @ model.outputs[noise].T + model.bias[noise] - log_noise[noise]
        # slopes of -log sigmoid(good) - sum log sigmoid(-bad)
        up = -1.0 / (1.0 + np.exp(np.clip(good, -30, 30)))
        down = 1.0 / (1.0 + np.exp(np.clip(-bad, -30, 30)))
        d_hidden = up[:, None] * model.outputs[target] + down @ model.outputs[noise]
        d_outputs = _summed(target, up[:, None] * hidden) + _summed(noise, down.T @ hidden)
        d_bias = np.bincount(target, up, CLASSES) + np.bincount(noise, down.sum(axis=0), CLASSES)
        d_positions = np.stack([x.T @ d_hidden for x in inputs])
        d_vectors = sum(_summed(c, d_hidden @ p.T) for c, p in zip(context, model.positions, strict=True))
        rate = RATE * (1.0 - 0.9 * step / STEPS)
        for weights, square, slope in zip(
            (model.vectors, model.positions, model.outputs, model.bias), squares,
            (d_vectors, d_positions, d_outputs, d_bias), strict=True,
        ):
            slope /= BATCH
            square += slope * slope
            weights -= rate * slope / np.sqrt(square)
    return model


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code, shape and row of all tokens in order; every text ends in the end token, whose shape is -1."""
    body, offsets = kernel.text_bytes(column)
    body = kernel.ascii_lower(body)
    starts, ends, rows = kernel.words(body, offsets, kernel.SOLID)
    count = len(offsets) - 1
    codes = kernel.word_hashes(body, starts, ends)
    last = body[ends - 1].astype(np.uint32) if len(ends) else np.zeros(0, np.uint32)
    prior = np.where(ends - starts > 1, body[ends - 2] if len(ends) else 0, 0).astype(np.uint32)
    with np.errstate(over="ignore"):
        shapes = (((last << np.uint32(8)) | prior) * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(SHAPES)
    # word k of row r moves r places back, behind the ends of the rows before
    place = np.arange(len(codes)) + rows
    tails = np.cumsum(np.bincount(rows, minlength=count)) + np.arange(count)
    total = len(codes) + count
    out_codes, out_shapes, out_rows = np.empty(total, np.uint64), np.empty(total, np.int64), np.empty(total, np.int64)
    out_codes[place], out_shapes[place], out_rows[place] = codes, shapes, rows
    out_codes[tails], out_shapes[tails], out_rows[tails] = END, -1, np.arange(count)
    return out_codes, out_shapes, out_rows


@dataclass
class Tree:
    """Units and where they stand. Lexicon by falling count, then a rare unit for each shape, then the end."""

    #: codes of the lexicon, ascending, and the unit of each
    codes: np.ndarray
    unit_of: np.ndarray
    #: by unit: class, group, and mass (count, or what the rare tokens of a shape have together)
    classes: np.ndarray
    groups: np.ndarray
    mass: np.ndarray
    #: units in the order of their groups, where each group starts in it, and where each class starts in the groups
    order: np.ndarray
    group_starts: np.ndarray
    class_starts: np.ndarray
    #: first place in the lexicon of codes with the same high bits, or higher ones
    slots: np.ndarray = field(init=False)

    def __post_init__(self):
        self.slots = np.searchsorted(self.codes >> np.uint64(64 - SLOT_BITS), np.arange(1 << SLOT_BITS, dtype=np.uint64)).astype(np.int32)

    def places(self, codes: np.ndarray) -> np.ndarray:
        """The first place in the lexicon whose code is not below, at most the last; codes are hashes, so a slot holds few."""
        last = len(self.codes) - 1
        at = np.minimum(self.slots.take((codes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)), last)
        behind = np.flatnonzero(self.codes.take(at) < codes)
        while len(behind):
            behind = behind[at[behind] < last]
            at[behind] += 1
            behind = behind[self.codes[at[behind]] < codes[behind]]
        return at

    @property
    def end(self) -> int:
        return len(self.codes) + SHAPES

    def units(self, codes: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        rare = np.where(shapes < 0, self.end, len(self.codes) + shapes)
        if not len(self.codes):
            return rare
        at = self.places(codes)
        return np.where((self.codes.take(at) == codes) & (shapes >= 0), self.unit_of.take(at), rare)

    def context(self, units: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        """The units two back and one back; before a text stand two ends."""
        back = []
        for distance in (2, 1):
            earlier = np.full(len(units), self.end)
            earlier[distance:] = np.where(rows[distance:] == rows[:-distance], units[:-distance], self.end)
            back.append(earlier)
        return back

    def cells(self, units: np.ndarray, rows: np.ndarray) -> np.ndarray:
        two, one = (self.classes[u] for u in self.context(units, rows))
        return (two * CLASSES + one) * CLASSES + self.classes[units]


def tree(codes: np.ndarray, shapes: np.ndarray, counts: np.ndarray, shape_totals: dict[int, tuple[int, int]]) -> Tree:
    """From the lexicon by falling count and (tokens, distinct tokens) of every shape."""
    words = shapes >= 0
    ends = counts[~words].sum() + shape_totals.get(-1, (0, 0))[0] * (not (~words).any())
    codes, shapes, counts = codes[words], shapes[words].astype(np.int64), counts[words]
    rank = np.arange(len(codes))
    classes = np.where(rank < OWN_CLASSES, rank, OWN_CLASSES + shapes)
    codes = codes.view(np.uint64)
    by_code = np.argsort(codes)
    n, v = (np.array([shape_totals.get(s, (0, 0))[k] for s in range(SHAPES)], np.float64) for k in (0, 1))
    rare = n - np.bincount(shapes, counts, SHAPES) + 0.1 * (v - np.bincount(shapes, minlength=SHAPES) + 1)
    classes = np.concatenate([classes, OWN_CLASSES + np.arange(SHAPES), [END_CLASS]])
    mass = np.concatenate([counts + 0.1, rare, [ends + 0.1]])
    # within a class by falling mass, the rare unit last in a group of its own
    is_rare = np.r_[np.zeros(len(codes), bool), np.ones(SHAPES, bool), False]
    order = np.lexsort((-mass, is_rare, classes))
    sizes = np.bincount(classes, minlength=CLASSES)
    place = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    new = (place % GROUP == 0) | is_rare[order]
    group_starts = np.flatnonzero(new)
    groups = np.empty(len(order), np.int64)
    groups[order] = np.cumsum(new) - 1
    class_starts = np.searchsorted(classes[order][group_starts], np.arange(CLASSES + 1))
    return Tree(codes[by_code], by_code, classes, groups, mass, order, np.r_[group_starts, len(order)], class_starts)


@dataclass
class Network:
    """Weights of a tree; outputs and biases of classes, groups and units (units in the order of their groups)."""

    vectors: np.ndarray
    positions: np.ndarray
    outputs: list[np.ndarray]
    biases: list[np.ndarray]

    def hidden(self, context: list[np.ndarray]) -> np.ndarray:
        return sum(self.vectors[c] @ p for c, p in zip(context, self.positions, strict=True))


def network(shape: Tree, start: Weights) -> Network:
    """The model of the classes as one of units: inputs as the class, shares within a class as the masses."""
    group = np.add.reduceat(shape.mass[shape.order], shape.group_starts[:-1])
    zeros = lambda n: np.zeros((n, WIDTH), np.float32)
    bias = lambda mass: np.log(mass / mass.sum()).astype(np.float32)
    return Network(
        start.vectors.astype(np.float32)[shape.classes], start.positions.astype(np.float32),
        [start.outputs.astype(np.float32), zeros(len(group)), zeros(len(shape.order))],
        [start.bias.astype(np.float32), bias(group), bias(shape.mass[shape.order])],
    )


def _grouped(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``at``, the sums of their ``rows`` in the order given, and how many there were."""
    bits = len(at).bit_length()
    keys = (at << bits) | np.arange(len(at))  # plain values sort much faster than places
    keys.sort()
    ordered = keys >> bits
    keys &= (1 << bits) - 1
    new = np.empty(len(at) + 1, bool)
    new[0] = new[-1] = True
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:-1])
    edges = new.nonzero()[0]
    first, counts = edges[:-1], edges[1:] - edges[:-1]
    # reduceat goes through each column of each run, which takes longer than a step for all short runs at once
    sums = rows.take(keys[first], axis=0)
    long = counts > SHORT_RUN
    if long.any():
        sums[long] = np.add.reduceat(rows.take(keys[np.repeat(long, counts)], axis=0), np.cumsum(counts[long]) - counts[long])
    short = np.flatnonzero((counts > 1) & ~long)
    if len(short):
        # the longest first, so that those with one more row are the first of them
        short = short[np.argsort(np.uint8(SHORT_RUN) - counts[short].astype(np.uint8), kind="stable")]
        begin, size = first[short], counts[short]
        rest = rows.take(keys[begin + 1], axis=0)
        for step, more in enumerate((len(size) - np.cumsum(np.bincount(size)))[2:-1].tolist(), 2):
            rest[:more] += rows.take(keys[begin[:more] + step], axis=0)
        sums[short] += rest
    return ordered[first], sums, counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(x)), in place; an exponential beyond the range of floats gives 0."""
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1.0
    return np.reciprocal(x, out=x)


class Learner:
    """Steps over the examples of one part, from common weights; ``changes`` are what it moved."""

    def __init__(self, shape: Tree, start: Network):
        self.shape, self.start = shape, start
        self.now = Network(start.vectors.copy(), start.positions.copy(), [x.copy() for x in start.outputs], start.biases)
        self.random = np.random.default_rng(11)
        self.tables = [self.now.vectors, *self.now.outputs]
        self.squares = [np.ones(len(x), np.float32) for x in self.tables]
        self.times = [np.zeros(len(x), np.int64) for x in self.tables]
        self.square = np.ones_like(start.positions)
        self.examples = 0
        self.rank = np.empty(len(shape.order), np.int64)
        self.rank[shape.order] = np.arange(len(shape.order))
        shares = [np.exp(b.astype(np.float64)) for b in start.biases]
        self.running = [np.cumsum(x / x.sum()) for x in shares]

    def _move(self, table: int, at: np.ndarray, rows: np.ndarray) -> None:
        found, slope, times = _grouped(at, rows)
        square = self.squares[table].take(found) + np.einsum("ij,ij->i", slope, slope) / np.float32(slope.shape[1])
        self.squares[table][found] = square
        slope *= (STREAM_RATE / np.sqrt(square))[:, None]
        self.tables[table][found] = np.subtract(self.tables[table].take(found, axis=0), slope, out=slope)
        self.times[table][found] += times

    def _level(self, level: int, truth: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Moves the outputs of one level towards the truth and away from noise; slopes of what was seen."""
        outputs, bias, k = self.now.outputs[level], self.now.biases[level], STREAM_NOISE[level]
        noise = np.minimum(np.searchsorted(self.running[level], self.random.random(k)), len(bias) - 1)
        # the bias is the logarithm of the noise, so only log(k) of the offset is left
        offset = np.float32(np.log(k))
        true_rows, noise_rows = outputs.take(truth, axis=0), outputs.take(noise, axis=0)
        up = _sigmoid(np.einsum("ij,ij->i", seen, true_rows) - offset)[:, None]
        down = seen @ noise_rows.T
        down = _sigmoid(np.subtract(offset, down, out=down))
        slopes = down @ noise_rows
        true_rows *= up
        slopes -= true_rows
        moved = np.empty((len(truth) + k, seen.shape[1]), np.float32)
        np.multiply(seen, -up, out=moved[: len(truth)])
        np.matmul(down.T, seen, out=moved[len(truth) :])
        self._move(level + 1, np.concatenate([truth, noise]), moved)
        return slopes

    def _step(self, context: list[np.ndarray], target: np.ndarray) -> None:
        now, shape = self.now, self.shape
        inputs = [now.vectors.take(c, axis=0) for c in context]
        hidden = inputs[0] @ now.positions[0]
        hidden += inputs[1] @ now.positions[1]
        classes = shape.classes[target]
        d_hidden = self._level(0, classes, hidden)
        inner = np.flatnonzero((classes >= OWN_CLASSES) & (classes < END_CLASS))  # the others are alone in their class
        if len(inner):
            seen, within = hidden.take(inner, axis=0), target[inner]
            d_seen = self._level(1, shape.groups[within], seen)
            d_seen += self._level(2, self.rank[within], seen)
            d_hidden[inner] = d_hidden.take(inner, axis=0) + d_seen
        slopes = np.stack([x.T @ d_hidden for x in inputs])
        moved = np.empty((2, *d_hidden.shape), np.float32)
        for p, out in zip(now.positions, moved, strict=True):
            np.matmul(d_hidden, p.T, out=out)
        self._move(0, np.concatenate(context), moved.reshape(-1, WIDTH))
        self.square += slopes * slopes
        now.positions -= STREAM_RATE * slopes / np.sqrt(self.square)

    def learn(self, units: np.ndarray, rows: np.ndarray) -> None:
        context = self.shape.context(units, rows)
        mixed = self.random.permutation(len(units))
        for low in range(0, len(units), STREAM_BATCH):
            some = mixed[low : low + STREAM_BATCH]
            self._step([c[some] for c in context], units[some])
        self.examples += len(units)

    def changes(self) -> Iterator[tuple[int, int, bytes, bytes]]:
        """Table, block, times and times x change of the rows that were trained; table -1 has the positions."""
        if not self.examples:
            return
        moved = (self.now.positions - self.start.positions) * np.float32(self.examples)
        yield -1, 0, np.array([self.examples], np.float32).tobytes(), moved.astype(np.float32).tobytes()
        for table, (after, before) in enumerate(zip(self.tables, [self.start.vectors, *self.start.outputs], strict=True)):
            for low in range(0, len(after), BLOCK):
                times = self.times[table][low : low + BLOCK].astype(np.float32)
                if times.any():
                    moved = (after[low : low + BLOCK] - before[low : low + BLOCK]) * times[:, None]
                    yield table, low // BLOCK, times.tobytes(), moved.astype(np.float32).tobytes()


def _added(rows: Iterator[tuple[int, int, bytes, bytes]]) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Sums of times and changes by table and block."""
    sums: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for table, block, times, moved in rows:
        n, x = np.frombuffer(times, np.float32), np.frombuffer(moved, np.float32)
        have = sums.setdefault((table, block), (np.zeros(n.shape), np.zeros(x.shape)))
        have[0].__iadd__(n)
        have[1].__iadd__(x)
    return sums


_CHANGES = pa.schema([
    ("part", pa.int64()), ("table", pa.int32()), ("block", pa.int32()), ("times", pa.binary()), ("moved", pa.binary()),
])


def _batches(part: int, rows: Iterator[tuple[int, int, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
    for row in rows:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((part, *row), _CHANGES, strict=True)], schema=_CHANGES)


def averaged(texts: DataFrame, parts: int, shared, start: Network) -> Network:
    """``start`` moved by the changes of all parts, by row weighted with the examples behind them.

    ``texts`` are rows of id and units. Rows alike in both teach the same, so their order is free.
    """
    schema = "part long, table int, block int, times binary, moved binary"

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, learner, held, size = None, None, [], 0

        def take() -> None:
            nonlocal size
            if held:
                learner.learn(np.concatenate(held), np.repeat(np.arange(len(held)), [len(x) for x in held]))
            held.clear()
            size = 0

        for piece in kernel.slices(batches, "_units", COUNT_BYTES):
            units, counts = unpacked(piece.column("_units"))
            for of, some in zip(piece.column("_part").to_pylist(), np.split(units, np.cumsum(counts)[:-1]), strict=True):
                if of != part:
                    if learner is not None:
                        take()
                        yield from _batches(part, learner.changes())
                    part, learner = of, Learner(*shared.value)
                held.append(some)
                size += len(some)
                if size >= MIXED_TOKENS:
                    take()
        if learner is not None:
            take()
            yield from _batches(part, learner.changes())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _added(row[1:] for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        yield from _batches(0, ((*key, n.astype(np.float32).tobytes(), x.astype(np.float32).tobytes()) for key, (n, x) in sums.items()))

    part = F.pmod(F.xxhash64("_id", "_units"), F.lit(parts))
    dealt = texts.select(part.alias("_part"), "_id", "_units").repartitionById(parts, F.col("_part").cast("int"))
    changes = dealt.sortWithinPartitions("_part", "_id", "_units").select("_part", "_units").mapInArrow(learn, schema)
    sums = changes.repartition("table", "block").sortWithinPartitions("table", "block", "part").mapInArrow(add, schema)
    out = Network(start.vectors.copy(), start.positions.copy(), [x.copy() for x in start.outputs], start.biases)
    tables = [out.vectors, *out.outputs]
    for r in sums.collect():  # one row for each block of units at most
        n, x = np.frombuffer(r["times"], np.float32), np.frombuffer(r["moved"], np.float32)
        if r["table"] < 0:
            out.positions += x.reshape(out.positions.shape) / n[0]
        else:
            low = r["block"] * BLOCK
            tables[r["table"]][low : low + len(n)] += x.reshape(-1, WIDTH) / np.maximum(n, 1)[:, None]
    return out


#: sums of exponentials beyond these are near the end of the range of floats
SMALL, LARGE = 1e-25, 1e30


def _choices(hidden: np.ndarray, edges: np.ndarray, parents: np.ndarray, chosen: np.ndarray, starts: np.ndarray, outputs: np.ndarray) -> np.ndarray:
    """Natural logarithms of choosing ``chosen`` among the children of each parent, which lie between its starts.

    Rows between two edges have one parent. The last column of ``outputs`` is the bias, that of ``hidden`` is 1.
    """
    out = np.zeros(len(hidden), np.float32)
    sums = np.ones(len(hidden), np.float32)
    for low, high, first, last in zip(edges[:-1].tolist(), edges[1:].tolist(), starts[parents].tolist(), starts[parents + 1].tolist(), strict=True):
        width = last - first
        if width == 1:
            continue
        children, ones = outputs[first:last].T, np.ones(width, np.float32)
        # the scores of so many rows stay in the cache
        for at in range(low, high, 1 << 10):
            end = min(at + (1 << 10), high)
            scores = hidden[at:end] @ children
            place = np.arange(0, scores.size, width) + (chosen[at:end] - first)
            out[at:end] = scores.ravel().take(place)
            with np.errstate(over="ignore"):
                total = np.exp(scores, out=scores) @ ones
            if not (total.min() > SMALL and total.max() < LARGE):  # once more, with the highest score of each row at 0
                scores = hidden[at:end] @ children
                scores -= scores.max(axis=1, keepdims=True)
                out[at:end] = scores.ravel()[place]
                total = np.exp(scores, out=scores) @ ones
            sums[at:end] = total
    return out - np.log(sums)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the runs of equal keys, and the key of each."""
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return np.r_[first, len(keys)], keys[first]


@dataclass
class Scorer:
    """What the tasks need to score: input vectors by position, already moved, and outputs with their biases."""

    shape: Tree
    moved: list[np.ndarray]
    outputs: list[np.ndarray]
    rank: np.ndarray = field(repr=False)
    log_mass: np.ndarray = field(repr=False)

    def log10(self, units: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Of every unit after those before it."""
        return self.log10_after(self.shape.context(units, rows), units)

    def log10_after(self, context: list[np.ndarray], units: np.ndarray) -> np.ndarray:
        shape = self.shape
        # by group, and thereby by class, so that few rows of hidden units are held at a time and each is made once
        groups = shape.groups.astype(np.uint16 if len(shape.group_starts) < 1 << 16 else np.int64).take(units)
        sort = np.argsort(groups, kind="stable")
        out = np.empty(len(units), np.float32)
        for low in range(0, len(units), HELD_ROWS):
            some = sort[low : low + HELD_ROWS]
            out[some] = self._sorted([c.take(some) for c in context], units.take(some))
        return out.astype(np.float64) / np.log(10)

    def _sorted(self, context: list[np.ndarray], units: np.ndarray) -> np.ndarray:
        """Natural logarithms for units in the order of their groups."""
        shape = self.shape
        # rows are gathered by take, which is several times faster than an index
        hidden = self.moved[0].take(context[0], axis=0)
        hidden += self.moved[1].take(context[1], axis=0)
        classes, groups = shape.classes.take(units), shape.groups.take(units)
        out = _choices(hidden, np.array([0, len(units)]), np.zeros(1, int), classes, np.array([0, CLASSES]), self.outputs[0])
        # own classes come first and the end last; both are alone in their class
        low, high = np.searchsorted(classes, [OWN_CLASSES, END_CLASS])
        hidden, classes, groups = hidden[low:high], classes[low:high], groups[low:high]
        out[low:high] += _choices(hidden, *_runs(classes), groups, shape.class_starts, self.outputs[1])
        out[low:high] += _choices(hidden, *_runs(groups), self.rank.take(units[low:high]), shape.group_starts, self.outputs[2])
        return out


def scorer(shape: Tree, weights: Network) -> Scorer:
    rank = np.empty(len(shape.order), np.int64)
    rank[shape.order] = np.arange(len(shape.order))
    # the constant 1 of the biases comes with the nearer position
    moved = [np.c_[weights.vectors @ p, np.full(len(weights.vectors), k, np.float32)] for k, p in enumerate(weights.positions)]
    outputs = [np.c_[o, b].astype(np.float32) for o, b in zip(weights.outputs, weights.biases, strict=True)]
    return Scorer(shape, moved, outputs, rank, np.log10(shape.mass))


def packed(units: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The units of each row in bytes: their low halves, then what is above them, which is mostly 0."""
    sizes = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts * 3, out=sizes[1:])
    low = np.repeat(sizes[:-1] - 2 * (np.cumsum(counts) - counts), counts) + 2 * np.arange(len(units))
    high = np.repeat(sizes[:-1] + 2 * counts - (np.cumsum(counts) - counts), counts) + np.arange(len(units))
    body = np.empty(3 * len(units), np.uint8)
    body[low], body[low + 1], body[high] = units & 255, units >> 8 & 255, units >> 16
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(sizes), pa.py_buffer(body)])


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """What a binary column lies in, and where each row starts and ends in that."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body, np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The units of all rows end to end, and how many each row has."""
    body, offsets = _bytes(column)
    counts = np.diff(offsets) // 3
    before = np.cumsum(counts) - counts
    low = np.repeat(offsets[:-1] - 2 * before, counts) + 2 * np.arange(counts.sum())
    high = np.repeat(offsets[:-1] + 2 * counts - before, counts) + np.arange(counts.sum())
    return body[low].astype(np.int64) | body[low + 1].astype(np.int64) << 8 | body[high].astype(np.int64) << 16, counts


def _map(df: DataFrame, function, schema: str, limit: int, column: str = "_text") -> DataFrame:
    return kernel.arrow_map(df, function, T._parse_datatype_string(schema), column, limit)


def _token_counts(training: DataFrame) -> DataFrame:
    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, shapes, _ = tokens(batch.column("_text"))
        coded = pa.array(codes.view(np.int64)).dictionary_encode()
        number = coded.indices.to_numpy()
        shape = np.empty(len(coded.dictionary), np.int32)
        shape[number] = shapes  # all places of a token have its shape
        return pa.RecordBatch.from_arrays(
            [coded.dictionary, pa.array(shape), pa.array(np.bincount(number, minlength=len(shape)))], names=["token", "shape", "n"]
        )

    found = _map(training.select("_text"), count, "token long, shape int, n long", COUNT_BYTES)
    return found.groupBy("token").agg(F.min("shape").alias("shape"), F.sum("n").alias("c"))


def _in_units(source: DataFrame, shared) -> DataFrame:
    """The units of every text, and the codes of its rare tokens in order."""
    kind = source.schema["_id"].dataType.simpleString()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        shape = shared.value
        codes, shapes, rows = tokens(batch.column("_text"))
        units = shape.units(codes, shapes)
        rare = (units >= len(shape.codes)) & (units < shape.end)
        ends = np.zeros(batch.num_rows + 1, np.int32)
        np.cumsum(8 * np.bincount(rows[rare], minlength=batch.num_rows), out=ends[1:])
        spelled = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(codes[rare])])
        return pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_train"), packed(units, np.bincount(rows, minlength=batch.num_rows)), spelled],
            names=["_id", "_train", "_units", "_rare"],
        )

    return _map(source, cut, f"_id {kind}, _train boolean, _units binary, _rare binary", COUNT_BYTES)


def _trigram_counts(training: DataFrame, shared) -> DataFrame:
    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        units, counts = unpacked(batch.column("_units"))
        n = np.bincount(shared.value.cells(units, np.repeat(np.arange(len(counts)), counts)))  # CLASSES**3 at most
        cells = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n[cells])], names=["cell", "n"])

    found = _map(training.select("_units"), count, "cell long, n long", COUNT_BYTES, "_units")
    return found.groupBy("cell").agg(F.sum("n").alias("n"))


def _scored_units(texts: DataFrame, shared) -> DataFrame:
    """For every text its tokens, the frequent ones of them, and log10 without the counts of the rare ones: of the model, of the counts."""
    kind = texts.schema["_id"].dataType.simpleString()

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        scorer = shared.value
        shape = scorer.shape
        units, counts = unpacked(batch.column("_units"))
        count = batch.num_rows
        rows = np.repeat(np.arange(count), counts)
        share = scorer.log10(units, rows)
        rare = (units >= len(shape.codes)) & (units < shape.end)
        # without training rows the end is unknown as well
        frequent = ~rare & ((units != shape.end) | (shape.mass[shape.end] > 1))
        logs = scorer.log_mass.take(units)
        share[rare] -= logs[rare]
        logs[rare] = 0.0
        total = lambda x: np.bincount(rows, x, count)
        return pa.RecordBatch.from_arrays([
            batch.column("_uid"), batch.column("_id"), pa.array(counts), pa.array(total(frequent).astype(np.int64)),
            pa.array(total(share)), pa.array(total(logs)),
        ], names=["_uid", "_id", "n_tokens", "n_known", "model", "logs"])

    schema = f"_uid long, _id {kind}, n_tokens long, n_known long, model double, logs double"
    return _map(texts.select("_uid", "_id", "_units"), score, schema, COUNT_BYTES, "_units")


def _rare_counts(texts: DataFrame) -> DataFrame:
    """The rare tokens of every text with their number in it."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        spelled, places = _bytes(batch.column("_rare"))
        codes = spelled[places[0] : places[-1]].copy().view(np.uint64)
        of = np.repeat(np.arange(batch.num_rows), np.diff(places) // 8)
        with np.errstate(over="ignore"):
            sort = np.argsort(codes + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        token, row = codes[sort], of[sort]
        first = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (row[1:] != row[:-1])]) if len(token) else np.zeros(0, int)
        times = np.diff(first, append=len(token)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [batch.column("_uid").take(pa.array(row[first])), pa.array(token[first].view(np.int64)), pa.array(times)],
            names=["_uid", "token", "n"],
        )

    return _map(texts.select("_uid", "_rare"), count, "_uid long, token long, n int", COUNT_BYTES, "_rare")


def _columns(df: DataFrame) -> list[np.ndarray]:
    table = df.toArrow()
    return [table.column(k).to_numpy() for k in range(table.num_columns)]


def scored(docs: DataFrame, keep: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, n_known, train_tokens, base_score and score (both log10).

    The rows that ``keep`` (over the id) admits are learned from; a null id is not. Tokens are the runs
    of bytes other than ASCII white space, A-Z lowered, and one end per text. ``base_score`` is the
    smoothed unigram model. Null is an empty text, which is the end token alone. Repeated rows are scored each
    and count each. Other columns are not read; an empty table gives no rows; without training
    rows all tokens are unknown.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.coalesce(keep, F.lit(False)).alias("_train"),
    )
    training = source.where("_train")
    counts = settled(_token_counts(training), "token-counts")
    total, distinct = counts.agg(F.sum("c"), F.count("*")).first()
    total = int(total or 0)
    shape_totals = {r["shape"]: (int(r["n"]), int(r["v"])) for r in
                    counts.groupBy("shape").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    codes, shapes, c = _columns(counts.orderBy(F.desc("c"), "token").limit(LEXICON))
    shape = tree(codes, shapes, c, shape_totals)
    shared_tree = spark.sparkContext.broadcast(shape)
    texts = settled(_in_units(source, shared_tree).withColumn("_uid", F.monotonically_increasing_id()), "units")
    known = texts.where("_train")
    cells, n = _columns(_trigram_counts(known, shared_tree))  # CLASSES**3 cells at most
    shared_tree.unpersist()
    by_cell = np.argsort(cells)
    start = network(shape, train(cells[by_cell], n[by_cell]))
    # LEXICON units at most, here and below
    weights = start
    if total:
        shared_start = spark.sparkContext.broadcast((shape, start))
        weights = averaged(known, -(-total // PART_TOKENS), shared_start, start)
        shared_start.unpersist()
    found = _scored_units(texts, spark.sparkContext.broadcast(scorer(shape, weights)))
    own_logs = F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))
    rare = _rare_counts(texts).join(counts.select("token", "c"), "token", "left").select(
        "_uid", F.lit(None).cast(found.schema["_id"].dataType).alias("_id"), F.lit(0).cast("long").alias("n_tokens"),
        F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0).cast("long").alias("n_known"),
        own_logs.alias("model"), own_logs.alias("logs"),
    )
    found = found.unionByName(rare).groupBy("_uid").agg(
        F.max("_id").alias(id_col), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("logs").alias("_logs"), F.sum("model").alias("score"),
    )
    scale = float(np.log10(total + 0.1 * (distinct + 1)))
    return found.select(
        id_col, "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("_logs") - F.col("n_tokens") * scale).alias("base_score"), "score",
    )
