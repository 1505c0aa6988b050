"""Distinct sampled segmentations of whole texts into pieces of a public vocabulary, and decoding.

A text (spaces as the word mark, one before the text) is a lattice of vocabulary pieces; characters
without a piece fall back to byte pieces. Pieces do not cross a space or a line end, so the lattice is a
chain of units, and equal units of a slice share their part. Piece weights follow Zipf's law over the
ranks of the vocabulary. Backward sums turn them into the probability of every next piece, so the
probability of a segmentation is a product of choices.

Gumbel top-k: with an independent Gumbel noise on the log probability of every segmentation, the k
largest are a sample without replacement. They are found by an A-star search over prefixes: the bound of
a prefix is the largest perturbed value below it, which is drawn top down (a group of alternatives has
a Gumbel of its mass, cut off at its parent's). The best prefix is completed by plain sampling, and its
alternatives join the agenda. The value that comes next after the k taken is the threshold of the
inclusion probabilities. All noise is a hash of the row's key.
"""

from __future__ import annotations

import functools
import heapq
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazemart.llm import kernel

SAMPLES = 3
SLICE_BYTES = 1 << 19
FILTER_BITS = 20
PREFIX_BITS = 22
CACHED_EDGES = 2_000_000
SPACE, LINE = 32, 10
#: logarithms of exponential waits made from 53 random bits lie between -37 and 4
NOISE_SPAN = 42.0
#: choices that are looked at first; nearly always enough
REACH = 640


@dataclass
class Vocabulary:
    """Pieces as bytes with a plain space as mark, by id; the sorted hashes of the usable ones.

    ``slots`` has the first place in the hashes by their high bits, -1 where no hash has those.
    """

    pieces: list[bytes]
    hashes: np.ndarray
    ids: np.ndarray
    weights: np.ndarray
    byte_ids: np.ndarray
    byte_weight: float
    longest: int
    slots: np.ndarray
    prefixes: np.ndarray
    body: np.ndarray
    bounds: np.ndarray

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of some pieces end to end."""
        size = self.bounds[ids + 1] - self.bounds[ids]
        at = np.repeat(self.bounds[ids] - (np.cumsum(size) - size), size)
        return self.body[at + np.arange(len(at))]


def _span_hash(raw: list[bytes]) -> np.ndarray:
    body = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    return kernel.word_hashes(body, ends - np.array([len(r) for r in raw]), ends)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, usable, byte_ids = [], [], np.full(256, -1, np.int32)
    lowest = 0.0
    for i in range(model.get_piece_size()):
        text = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(text[3:5], 16)] = i
            pieces.append(bytes([int(text[3:5], 16)]))
            continue
        raw = text.replace("▁", " ").encode()
        pieces.append(b"" if model.is_control(i) or model.is_unknown(i) else raw)
        if pieces[-1] and b" " not in raw[1:] and b"\n" not in raw:
            usable.append(i)
            lowest = min(lowest, model.get_score(i))
    hashes = _span_hash([pieces[i] for i in usable])
    order = np.argsort(hashes)
    ids = np.array(usable, np.int32)[order]
    ranks = -np.array([model.get_score(int(i)) for i in ids])
    hashes = hashes[order]
    slots = np.full(1 << FILTER_BITS, -1, np.int32)
    slots[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)[::-1]] = np.arange(len(hashes))[::-1]
    heads = sorted({pieces[i][:n] for i in usable for n in range(1, len(pieces[i]))})
    prefixes = np.zeros(1 << PREFIX_BITS, bool)
    prefixes[(_span_hash(heads) >> np.uint64(64 - PREFIX_BITS)).astype(np.int64)] = True
    return Vocabulary(
        pieces, hashes, ids, -np.log(ranks + 2.0), byte_ids, -float(np.log(2.0 - lowest)),
        max(len(pieces[i]) for i in usable), slots, prefixes, np.frombuffer(b"".join(pieces), np.uint8),
        np.r_[0, np.cumsum([len(p) for p in pieces])],
    )


@dataclass
class Lattice:
    """Edges sorted by start; a unit's last position has none. Positions count through all units of a slice.

    ``below`` is the probability of the edges before it with the same start, ``others`` the logarithm of that of all other edges;
    ``onward`` is the last edge of its target, -1 at a unit's end.
    """

    first: np.ndarray
    degree: np.ndarray
    source: np.ndarray
    target: np.ndarray
    piece: np.ndarray
    log_p: np.ndarray
    below: np.ndarray
    others: np.ndarray
    onward: np.ndarray

    def last(self, nodes: np.ndarray) -> np.ndarray:
        """The last edge of each position, -1 where it has none."""
        degree = self.degree.take(nodes)
        return np.where(degree > 0, self.first.take(nodes) + degree - np.int32(1), np.int32(-1))


def build_lattice(body: np.ndarray, starts: np.ndarray, lengths: np.ndarray, vocab: Vocabulary) -> tuple[Lattice, np.ndarray]:
    """The lattice of some spans of ``body`` and the first position of each span."""
    sizes = lengths + 1
    begin = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    unit = np.repeat(np.arange(len(starts)), sizes)
    offset = np.arange(total) - begin[unit]
    source = starts[unit] + offset
    inner = offset < lengths[unit]
    char = np.zeros(total, np.uint8)
    char[inner] = body[source[inner]]
    head = inner & ((char & 0xC0) != 0x80)
    left = lengths[unit] - offset
    # hashes of spans from running sums over the compact bytes
    with np.errstate(over="ignore"):
        power = np.full(total + 1, kernel._PRIME, np.uint64)
        power[0] = 1
        power = np.cumprod(power, dtype=np.uint64)
        inverse = np.full(total + 1, kernel._PRIME_INVERSE, np.uint64)
        inverse[0] = 1
        inverse = np.cumprod(inverse, dtype=np.uint64)
        sums = np.zeros(total + 1, np.uint64)
        np.cumsum(np.where(inner, kernel._CODES[char] * power[:-1], np.uint64(0)), dtype=np.uint64, out=sums[1:])
        live = np.flatnonzero(head)
        found = []  # (starts, sizes, ids, weights) by size
        for size in range(1, vocab.longest + 1):
            live = live[left[live] >= size]
            if not len(live):
                break
            code = kernel.mixed((sums[live + size] - sums[live]) * inverse[live] + np.uint64(size))
            at = vocab.slots.take((code >> np.uint64(64 - FILTER_BITS)).astype(np.int64))
            hit = np.flatnonzero(at >= 0)
            at, wanted = at.take(hit), code.take(hit)
            behind = np.flatnonzero(vocab.hashes.take(at) < wanted)
            while len(behind):  # few hashes share a slot
                behind = behind[at[behind] < len(vocab.hashes) - 1]
                at[behind] += 1
                behind = behind[vocab.hashes[at[behind]] < wanted[behind]]
            good = np.flatnonzero(vocab.hashes.take(at) == wanted)
            at = at.take(good)
            found.append((live.take(hit.take(good)), size, vocab.ids.take(at), vocab.weights.take(at)))
            live = live[vocab.prefixes.take((code >> np.uint64(64 - PREFIX_BITS)).astype(np.int64))]
    # characters without a piece of their own become bytes
    lead = np.where(char < 0x80, 1, np.where(char < 0xE0, 2, np.where(char < 0xF0, 3, 4)))
    covered = np.zeros(total, bool)
    for start, size, _, _ in found:
        covered[start[lead[start] == size]] = True
    owner = np.maximum.accumulate(np.where(head | ~inner, np.arange(total), 0))
    loose = np.flatnonzero(inner & ~covered[owner])
    found.append((loose, 1, vocab.byte_ids[char[loose]], np.full(len(loose), vocab.byte_weight)))
    # edges go to their start's range, shorter ones first: a position never starts two of one size
    degree = sum(np.bincount(start, minlength=total) for start, *_ in found).astype(np.int32)
    first = (np.cumsum(degree) - degree).astype(np.int32)
    count = int(degree.sum())
    froms, tos, pieces, weights = np.empty(count, np.int32), np.empty(count, np.int32), np.empty(count, np.int32), np.empty(count)
    free = first.copy()
    for start, size, ids, weight in found:
        place = free[start]
        free[start] += 1
        froms[place], tos[place], pieces[place], weights[place] = start, start + size, ids, weight
    # backward sums, all positions with the same distance to their unit's end at once
    back = np.zeros(total)
    log_p = np.empty(count)
    distance = left[froms]
    if len(lengths) and lengths.max() < 1 << 16:
        distance = distance.astype(np.uint16)  # sorted by counting
    by_distance = np.argsort(distance, kind="stable")
    cuts = np.searchsorted(distance[by_distance], np.arange(1, int(lengths.max(initial=0)) + 2))
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        if low == high:
            continue
        edges = by_distance[low:high]
        value = weights[edges] + back[tos[edges]]
        start = froms[edges]
        groups = np.flatnonzero(np.r_[True, start[1:] != start[:-1]])
        top = np.maximum.reduceat(value, groups)
        width = np.diff(groups, append=len(edges))
        total_weight = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, width)), groups))
        back[start[groups]] = total_weight
        log_p[edges] = np.minimum(value - np.repeat(total_weight, width), 0.0)
    log_p[degree[froms] == 1] = 0.0
    share = np.cumsum(np.exp(log_p))
    before = np.r_[0.0, share][first]
    below = np.r_[0.0, share[:-1] - before[froms[:-1]]] if count else share
    below[first[degree > 0]] = 0.0
    others = np.log(np.maximum(-np.expm1(log_p), 1e-300))
    others[log_p >= 0] = -np.inf
    onward = np.where(degree > 0, first + degree - np.int32(1), np.int32(-1)).take(tos)
    return Lattice(first, degree, froms, tos, pieces, log_p, below, others, onward), begin


class LatticeCache:
    """Lattices of the units met first in a worker, up to ``CACHED_EDGES``; those are the frequent ones.

    The lattice of a slice is written behind the kept ones, so these are not copied for each slice.
    """

    def __init__(self, vocab: Vocabulary):
        self._vocab = vocab
        empty, self._begin = build_lattice(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64), vocab)
        self._room = {f.name: getattr(empty, f.name) for f in fields(Lattice)}
        self._nodes = self._edges = 0
        self._codes = np.zeros(0, np.uint64)

    def _behind(self, name: str, kept: int, values: np.ndarray) -> np.ndarray:
        """The kept values with some more behind them."""
        room, size = self._room[name], kept + len(values)
        if size > len(room):
            self._room[name] = np.empty(size + size // 4, room.dtype)
            self._room[name][:kept] = room[:kept]
            room = self._room[name]
        room[kept:size] = values
        return room[:size]

    def of(self, body: np.ndarray, starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[Lattice, np.ndarray]:
        """A lattice that holds some different units, and the first position of each; the next call may write over it."""
        at = np.minimum(np.searchsorted(self._codes, codes), max(0, len(self._codes) - 1))
        known = self._codes[at] == codes if len(self._codes) else np.zeros(len(codes), bool)
        root = np.empty(len(codes), np.int64)
        root[known] = self._begin[at[known]]
        new = np.flatnonzero(~known)
        own, begin = build_lattice(body, starts[new], lengths[new], self._vocab)
        nodes, edges = self._nodes, self._edges
        own.first += np.int32(edges)
        own.source += np.int32(nodes)
        own.target += np.int32(nodes)
        own.onward[own.onward >= 0] += np.int32(edges)
        by_node = ("first", "degree")
        both = Lattice(*(
            self._behind(f.name, nodes if f.name in by_node else edges, getattr(own, f.name)) for f in fields(Lattice)
        ))
        root[new] = begin + nodes
        if len(both.target) <= CACHED_EDGES:
            self._nodes, self._edges = len(both.first), len(both.target)
            order = np.argsort(merged := np.concatenate([self._codes, codes[new]]))
            self._begin = np.concatenate([self._begin, root[new]])[order]
            self._codes = merged[order]
        return both, root


@functools.lru_cache(maxsize=2)
def lattice_cache(path: str) -> LatticeCache:
    return LatticeCache(vocabulary(path))


def _draw(lattice: Lattice, nodes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sampled path from each node to its unit's end: edges laid end to end and their number per node."""
    edge = lattice.last(nodes)
    live = np.flatnonzero(edge >= 0)
    edge, key = edge.take(live), keys.take(live)
    found = []
    counts = np.zeros(len(nodes), np.int64)
    while len(live):
        # the longest piece comes last and is mostly the likeliest; a piece alone has nothing below, and u is above 0
        u = kernel.uniform(kernel.mixed(key))
        moving = np.flatnonzero(u <= lattice.below.take(edge))
        while len(moving):
            edge[moving] -= 1
            moving = moving[u.take(moving) <= lattice.below.take(edge.take(moving))]
        found.append((live, edge))
        after = lattice.onward.take(edge)
        goes = after >= 0
        counts[live[~goes]] = len(found)
        with np.errstate(over="ignore"):
            live, edge, key = live[goes], after[goes], key[goes] * np.uint64(0xD1342543DE82EF95) + np.uint64(1)
    place = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int32)
    for step, (who, edge) in enumerate(found):
        out[place.take(who) + step] = edge
    return out, counts


def _units(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with the leading mark of every non-empty row, then start, length and row of the units."""
    sizes = np.diff(offsets)
    marked = (sizes > 0).astype(np.int64)
    base = np.cumsum(sizes + marked) - (sizes + marked)
    full = np.full(int((sizes + marked).sum()), SPACE, np.uint8)
    own = np.ones(len(full), bool)
    own[base[sizes > 0]] = False
    full[own] = body
    cut = (full == SPACE) | (full == LINE)
    cut[1:] |= full[:-1] == LINE
    cut[base[sizes > 0]] = True
    starts = np.flatnonzero(cut)
    filled = np.flatnonzero(sizes > 0)  # each begins with a unit
    rows = np.repeat(filled, np.diff(np.searchsorted(starts, base[filled]), append=len(starts)))
    return full, starts, np.diff(starts, append=len(full)), rows


class Path:
    """Edges of one segmentation of a row with the unit of each."""

    # kept at module level: a class made per call would hold its slice's arrays until a cycle collection

    def __init__(self, edges: np.ndarray, units: np.ndarray):
        self.edges, self.units = edges, units


def sample_rows(
    column: pa.Array, keys: np.ndarray, samples: int, vocab: Vocabulary, cache: LatticeCache | None = None
) -> list[tuple[int, int, np.ndarray, float, float]]:
    """(row, number from 1, piece ids, log probability, log inclusion probability) in order of the search."""
    body, offsets = kernel.text_bytes(column)
    count = len(offsets) - 1
    full, starts, lengths, rows = _units(body, offsets)
    out: list[tuple[int, int, np.ndarray, float, float]] = []
    for row in np.flatnonzero(np.diff(offsets) == 0):
        out.append((int(row), 1, np.zeros(0, np.int32), 0.0, 0.0))
    if not len(starts):
        return out
    codes = kernel.word_hashes(full, starts, starts + lengths)
    coded = pa.array(codes).dictionary_encode()
    shared, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    sample = np.empty(len(distinct), np.int64)
    sample[shared[::-1]] = np.arange(len(codes))[::-1]
    lattice, begin = (cache or LatticeCache(vocab)).of(full, starts[sample], lengths[sample], distinct)
    root = begin[shared]
    bounds = np.searchsorted(rows, np.arange(count + 1))
    place = (np.arange(len(starts)) - bounds[rows]).astype(np.uint64)

    def noise_seed(row: np.ndarray | int, number: int, salt: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return kernel.mixed(keys[row] + np.uint64((number * 0x9E3779B97F4A7C15 + salt) % (1 << 64)))

    def noise(seed: np.ndarray, where: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return kernel.mixed(seed + where * np.uint64(0xBF58476D1CE4E5B9))

    def alternatives(path: Path, row: int, number: int, since: int, bound: float, want: int, ahead: float) -> list[tuple]:
        """The ``want`` earliest groups of siblings of the choices from ``since`` on, as (log time, path, choice, excluded, ahead).

        ``ahead`` is the log probability of the choices before one.
        """
        # waits span less than NOISE_SPAN, so choices with a mass that far below others cannot be among the earliest
        reach, total = REACH, len(path.edges) - since
        while True:
            stop = min(total, reach)
            through = ahead + np.cumsum(lattice.log_p[path.edges[since : since + stop]])
            before = np.r_[ahead, through[:-1]]
            mass = before + lattice.others[path.edges[since : since + stop]]
            if stop == total:
                break
            least = np.partition(mass, stop - want)[stop - want]
            if through[-1] < least - NOISE_SPAN:
                break
            reach *= 4
        u = kernel.uniform(noise(noise_seed(row, number, 2), np.arange(since, since + stop, dtype=np.uint64)))
        times = np.logaddexp(bound, np.log(np.maximum(-np.log(u), 1e-300)) - mass)
        best = np.argpartition(times, want - 1)[:want] if want < stop else np.arange(stop)
        best = best[np.argsort(times[best], kind="stable")]
        return [
            (float(times[i]), path, since + int(i), (int(path.edges[since + i]),), float(before[i])) for i in best if np.isfinite(times[i])
        ]

    def all_alternatives(wanted: list[tuple[Path, int, int, int, float, int, float]]) -> list[list[tuple]]:
        """``alternatives`` of several rows at once, over the first ``REACH`` choices; the few that need more go one by one."""
        if not wanted:
            return []
        edge = np.zeros((len(wanted), REACH), np.int32)
        length = np.empty(len(wanted), np.int64)
        for k, (path, _, _, since, _, _, _) in enumerate(wanted):
            part = path.edges[since : since + REACH]
            edge[k, : len(part)] = part
            length[k] = len(path.edges) - since
        there = np.arange(REACH)[None, :] < length[:, None]
        before = np.empty((len(wanted), REACH + 1))
        before[:, 0] = 0.0
        np.cumsum(np.where(there, lattice.log_p.take(edge), 0.0), axis=1, out=before[:, 1:])
        before += np.array([w[6] for w in wanted])[:, None]
        mass = before[:, :-1] + np.where(there, lattice.others.take(edge), -np.inf)
        most = min(REACH, max(w[5] for w in wanted))
        least = -np.partition(-mass, most - 1, axis=1)[:, most - 1]
        enough = (length <= REACH) | ((before[:, -1] < least - NOISE_SPAN) & (max(w[5] for w in wanted) <= REACH))
        seeds = noise_seed(np.array([w[1] for w in wanted]), wanted[0][2], 2)  # all of one round
        where = np.array([w[3] for w in wanted])[:, None] + np.arange(REACH)[None, :]
        waits = -np.log(kernel.uniform(noise(seeds[:, None], where.astype(np.uint64))))
        waits = np.log(np.maximum(waits, 1e-300, out=waits), out=waits)
        waits -= mass
        # the bound moves all times of a row without changing their order
        best = np.argpartition(waits, most - 1, axis=1)[:, :most]
        times = np.logaddexp(np.array([w[4] for w in wanted])[:, None], np.take_along_axis(waits, best, axis=1))
        aheads = np.take_along_axis(before, best, axis=1)
        out = []
        for k, (path, row, number, since, bound, want, ahead) in enumerate(wanted):
            if not enough[k]:
                out.append(alternatives(path, row, number, since, bound, want, ahead))
                continue
            order = sorted((t, i, a) for t, i, a in zip(times[k].tolist(), best[k].tolist(), aheads[k].tolist(), strict=True) if t < np.inf)
            out.append([(t, path, since + i, (int(path.edges[since + i]),), a) for t, i, a in order[:want]])
        return out

    # the first segmentation of every row: plain sampling; its Gumbel is that of the whole mass
    edges, steps = _draw(lattice, root, noise(noise_seed(np.arange(count), 1, 1)[rows], place))
    unit_of = np.repeat(np.arange(len(starts), dtype=np.int32), steps)
    cuts = np.searchsorted(unit_of, bounds)
    active, agendas, taken, wanted = [], {}, {}, []
    bounds_u = kernel.uniform(noise(noise_seed(np.arange(count), 1, 3), np.zeros(count, np.uint64)))
    for row in np.flatnonzero(np.diff(bounds) > 0):
        row = int(row)
        path = Path(edges[cuts[row] : cuts[row + 1]], unit_of[cuts[row] : cuts[row + 1]])
        bound = float(np.log(max(-np.log(bounds_u[row]), 1e-300)))
        taken[row] = [path]
        active.append(row)
        wanted.append((path, row, 1, 0, bound, samples, 0.0))
    for (_, row, *_), found in zip(wanted, all_alternatives(wanted), strict=True):
        agendas[row] = [(t, n, *rest) for n, (t, *rest) in enumerate(found)]
        heapq.heapify(agendas[row])
    serial = samples
    for number in range(2, samples + 1):
        open_rows = [row for row in active if agendas[row]]
        if not open_rows:
            break
        seeds = noise_seed(np.array(open_rows), number, 4), noise_seed(np.array(open_rows), number, 5)
        draws = [kernel.uniform(noise(seed, np.full(len(open_rows), n, np.uint64))) for n, seed in enumerate(seeds, 1)]
        plans = [heapq.heappop(agendas[row]) for row in open_rows]
        # one of the siblings that are left for every row, and the time of those left after that
        node = lattice.source[[path.edges[choice] for _, _, path, choice, _, _ in plans]]
        first, degree = lattice.first[node], lattice.degree[node]
        free = np.arange(degree.max()) < degree[:, None]
        times_gone = [len(p[4]) for p in plans]
        gone = np.repeat(np.arange(len(plans)), times_gone)
        free[gone, np.array([e for p in plans for e in p[4]]) - first[gone]] = False
        odds = np.where(free, lattice.log_p.take(first[:, None] + np.arange(degree.max()), mode="clip"), -np.inf)
        running = np.cumsum(np.exp(odds - odds.max(axis=1, keepdims=True)), axis=1)
        pick = (running < (draws[0] * running[:, -1])[:, None]).sum(axis=1)
        chosen = first + pick
        odds[np.arange(len(plans)), pick] = -np.inf
        left = np.isfinite(odds.max(axis=1))
        mass = np.array([p[5] for p in plans]) + np.logaddexp.reduce(odds, axis=1)
        later = np.full(len(plans), np.inf)
        later[left] = np.logaddexp(np.array([p[0] for p in plans]), np.log(np.maximum(-np.log(draws[1]), 1e-300)) - mass)[left]
        through = (np.array([p[5] for p in plans]) + lattice.log_p[chosen]).tolist()
        # all completions of this round in one draw: the rest of the unit, then the units after it
        unit = np.array([path.units[choice] for _, _, path, choice, _, _ in plans], np.int64)
        sizes = bounds[np.array(open_rows) + 1] - unit
        ends = np.cumsum(sizes)
        units = np.arange(ends[-1]) + np.repeat(unit - (ends - sizes), sizes)
        nodes = root[units]
        nodes[ends - sizes] = lattice.target[chosen]
        drawn, steps = _draw(lattice, nodes, noise(np.repeat(noise_seed(np.array(open_rows), number, 1), sizes), place[units]))
        drawn_units = np.repeat(units.astype(np.int32), steps)
        drawn_ends = np.r_[0, np.cumsum(steps)[ends - 1]].tolist()
        wanted = []
        for k, (row, (bound, _, path, choice, excluded, ahead)) in enumerate(zip(open_rows, plans, strict=True)):
            tail = slice(drawn_ends[k], drawn_ends[k + 1])
            new = Path(
                np.concatenate([path.edges[:choice], chosen[k : k + 1].astype(np.int32), drawn[tail]]),
                np.concatenate([path.units[: choice + 1], drawn_units[tail]]),
            )
            if left[k]:
                heapq.heappush(agendas[row], (float(later[k]), serial, path, choice, (*excluded, int(chosen[k])), ahead))
                serial += 1
            wanted.append((new, row, number, choice + 1, bound, samples - number + 1, through[k]))
            taken[row].append(new)
        for (_, row, *_), found in zip(wanted, all_alternatives(wanted), strict=True):
            for time, *rest in found:
                heapq.heappush(agendas[row], (time, serial, *rest))
                serial += 1
    every = [path.edges for row in active for path in taken[row]]
    ends = np.cumsum([len(e) for e in every])
    edges = np.concatenate(every)
    pieces = np.split(lattice.piece.take(edges), ends[:-1])
    log_ps = iter(zip(pieces, np.add.reduceat(lattice.log_p.take(edges), np.r_[0, ends[:-1]]).tolist(), strict=True))
    for row in active:
        limit = agendas[row][0][0] if agendas[row] else np.inf  # log time of the value after the last one taken
        for number in range(1, len(taken[row]) + 1):
            ids, log_p = next(log_ps)
            rate = log_p + limit
            inclusion = 0.0 if rate > 30 else float(np.log(-np.expm1(-np.exp(rate)))) if rate > -30 else rate
            out.append((row, number, ids, log_p, inclusion))
    return out


def decode(ids: list[int] | np.ndarray, vocab: Vocabulary) -> str:
    """The text of some piece ids, without the leading mark."""
    return vocab.spell(np.asarray(ids, np.int64)).tobytes()[1:].decode("utf-8", "replace")


def sampled_segmentations(
    docs: DataFrame, model: str, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
) -> DataFrame:
    """Up to ``samples`` distinct segmentations per row of ``docs``: id, sample (from 1, in order of perturbed value), n_tokens,
    log_prob, log_inclusion, ids_digest, restored (the decoded ids are the text) and ids if asked for.

    Null counts as empty text, whose only segmentation is empty, with probability and inclusion 1. A text
    with fewer segmentations than asked for gives all of them, with inclusion 1. The seed is a hash of the id, or of the
    text where the id is null, so repeated rows give equal results. Only id and text are read; an
    empty table gives no rows. Nothing is shuffled.
    """
    fields = [
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("sample", T.IntegerType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("log_prob", T.DoubleType()),
        T.StructField("log_inclusion", T.DoubleType()), T.StructField("ids_digest", T.LongType()),
        T.StructField("restored", T.BooleanType()),
    ] + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])
    schema = T.StructType(fields)
    key = F.when(F.col(id_col).isNotNull(), F.xxhash64(id_col)).otherwise(F.xxhash64(text_col))
    source = docs.select(F.col(id_col), F.coalesce(text_col, F.lit("")).alias("_text"), key.alias("_key"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        vocab = vocabulary(model)
        column = batch.column("_text")
        keys = kernel.mixed(batch.column("_key").to_numpy().view(np.uint64))
        found = sample_rows(column, keys, samples, vocab, lattice_cache(model))
        body, offsets = kernel.text_bytes(column)
        sizes = np.array([len(f[2]) for f in found])
        ids = np.concatenate([f[2] for f in found])
        spelled = _spelled(model).take(pa.array(ids))
        text = np.frombuffer(spelled.buffers()[2] or b"", np.uint8)
        # each text spelled begins with the mark, unless it is empty
        ends = np.frombuffer(spelled.buffers()[1], np.int32)[np.r_[0, np.cumsum(sizes)]] if len(ids) else np.zeros(len(found) + 1, int)
        restored = [
            np.array_equal(text[low + 1 : high], body[offsets[f[0]] : offsets[f[0] + 1]])
            for f, low, high in zip(found, ends[:-1].tolist(), ends[1:].tolist(), strict=True)
        ]
        columns = [
            batch.column(0).take(pa.array([f[0] for f in found], pa.int64())), pa.array([f[1] for f in found], pa.int32()),
            pa.array(sizes, pa.int64()), pa.array([f[3] for f in found], pa.float64()),
            pa.array([f[4] for f in found], pa.float64()), pa.array(digests(ids, sizes)), pa.array(restored),
        ]
        if with_ids:
            columns.append(kernel.lists(ids, sizes, pa.int32()))
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kernel.arrow_map(source, run, schema, "_text", SLICE_BYTES)


@functools.lru_cache(maxsize=2)
def _spelled(path: str) -> pa.Array:
    """The bytes of every piece by id."""
    return pa.array(vocabulary(path).pieces, pa.binary())


def digest(ids: np.ndarray) -> int:
    """A 64-bit hash of a sequence of ids."""
    return int(digests(ids, np.array([len(ids)]))[0])


def digests(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The hash of each of some sequences, which lie end to end."""
    first = np.cumsum(sizes) - sizes
    places = _places(1 << max(10, int(sizes.max(initial=0)).bit_length()))
    out = np.zeros(len(sizes), np.uint64)
    with np.errstate(over="ignore"):
        codes = kernel.mixed(ids.astype(np.uint64) + places[np.arange(len(ids)) - np.repeat(first, sizes)])
        if len(ids):
            out[sizes > 0] = np.add.reduceat(codes, first[sizes > 0])
    return out.view(np.int64)


@functools.lru_cache(maxsize=8)
def _places(count: int) -> np.ndarray:
    """A code for each place in a sequence."""
    with np.errstate(over="ignore"):
        return kernel.mixed(np.arange(1, count + 1, dtype=np.uint64))


def decoded(encoded: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column text in place of any of that name: the text of its piece ids; null ids give null."""
    columns = [c for c in encoded.columns if c != "text"]
    schema = T.StructType([*[encoded.schema[c] for c in columns], T.StructField("text", T.StringType())])

    def run(batches):
        for batch in batches:
            vocab = vocabulary(model)
            texts = [None if ids is None else decode(ids, vocab) for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return encoded.select(*columns).mapInArrow(run, schema)
