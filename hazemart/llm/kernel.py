"""Whole-text numpy kernels that the tasks of several operators share.

Texts stay in the bytes Arrow delivers. A batch is cut into slices of about ``SLICE_BYTES`` at row
boundaries, so the memory of a task does not depend on how many rows a batch holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SLICE_BYTES = 1 << 20

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_PRIME_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# one fixed 64-bit code per byte value, from a fixed generator
_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, size=256, dtype=np.uint64) | np.uint64(1)

#: letters, digits, underscore and every byte of a character beyond ASCII
WORDISH = np.zeros(256, dtype=bool)
WORDISH[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = True
#: letters and every byte of a character beyond ASCII
LETTERISH = WORDISH.copy()
LETTERISH[[*range(48, 58), 95]] = False
#: everything but the six white space bytes of ASCII
SOLID = np.ones(256, dtype=bool)
SOLID[[9, 10, 11, 12, 13, 32]] = False


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * (1.0 / (1 << 53))


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose ``column`` holds about ``limit`` bytes, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes) - sizes) // limit
        edges = np.flatnonzero(np.diff(part)) + 1
        for low, high in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            if high > low:
                yield batch.slice(int(low), int(high - low))


def text_bytes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the row offsets into them; null is empty.

    ``lower`` folds case over all of Unicode.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if lower:
        column = pc.utf8_lower(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    body = np.frombuffer(data, dtype=np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
    return body, offsets - first


def ascii_lower(body: np.ndarray) -> np.ndarray:
    return body + (((body - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5))


def words(body: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of bytes of ``kind``; no run crosses a row."""
    inside = np.frombuffer(body.tobytes().translate(kind.tobytes()), bool)  # much faster than an index
    before, after = np.empty_like(inside), np.empty_like(inside)
    if len(inside):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        cuts = offsets[:-1][offsets[:-1] < len(inside)]
        before[cuts] = False
        after[(ends := offsets[1:][offsets[1:] > 0]) - 1] = False
        del ends
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))


#: powers that a worker keeps, enough for the slices of all operators
KEPT_POWERS = 1 << 22
_kept_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the prime and of its inverse; those of short bodies are kept for the next."""
    if count <= len(_kept_powers[0]):
        return _kept_powers[0][:count], _kept_powers[1][:count]
    out = []
    for base in (_PRIME, _PRIME_INVERSE):
        # an eighth more, so that slices of about one size do not begin anew
        powers = np.full(count + (count // 8 if count <= KEPT_POWERS else 0), base, np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers, dtype=np.uint64, out=powers))
    if count <= KEPT_POWERS:
        _kept_powers[:] = out
    return out[0][:count], out[1][:count]


def word_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, the same wherever it stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        power, inverse = _powers(len(body) + 1)
        total = np.zeros(len(body) + 1, np.uint64)
        codes = _CODES.take(body)
        codes *= power[:-1]
        np.cumsum(codes, dtype=np.uint64, out=total[1:])
        return mixed((total.take(ends) - total.take(starts)) * inverse.take(starts) + (ends - starts).astype(np.uint64))


def shingles(hashes: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``width`` words; a row with fewer words is one shingle of all of them."""
    if not len(hashes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        sums = hashes.copy()
        reach = np.ones(len(hashes), np.int64)
        factor = np.uint64(1)
        for step in range(1, width):
            factor = np.uint64(int(factor) * int(_PRIME) % (1 << 64))
            if step >= len(hashes):
                break
            joins = rows[:-step] == rows[step:]
            sums[:-step] += np.where(joins, hashes[step:] * factor, np.uint64(0))
            reach[:-step] += joins
        first = np.empty(len(rows), bool)
        first[0], first[1:] = True, rows[1:] != rows[:-1]
        whole = (reach == width) | first
        return mixed(sums[whole] + reach[whole].astype(np.uint64)), rows[whole]


def arrow_map(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: T.StructType, column: str,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """``function`` on every slice of ``df``, inside Spark's own partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, column, limit):
            out = function(piece)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from values laid end to end."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
