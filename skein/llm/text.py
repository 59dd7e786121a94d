"""Arrow text columns as flat byte arrays, cut into small slices, with the array kernels that several operators share.

Every operator streams Arrow batches through ``mapInArrow`` and works on slices of about a megabyte, so a task holds
one Arrow batch and the arrays of one slice whatever the size of the table; a text longer than a slice is a slice of
its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SLICE_BYTES = 1 << 20
#: Rows of an Arrow batch; texts are a few kB on average and some are very long.
BATCH_ROWS = 512
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x5851F42D4C957F2D


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows, so that long texts do not pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def filled(texts: pa.Array) -> pa.Array:
    """Nulls read as empty texts."""
    return pc.fill_null(texts, "")


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts in one array, and len + 1 offsets into it."""
    large = filled(texts).cast(pa.large_binary())
    _, offsets, data = large.buffers()
    if len(large) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64)[large.offset : large.offset + len(large) + 1]
    flat = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, cut so that the texts of one piece come to about ``size`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        starts = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)[:-1]))
        cuts = np.flatnonzero(np.diff(starts // size)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(int(lo), int(hi - lo))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random 64-bit number for each byte value, by the rule above.
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n; kept up to a slice or so."""
    size = 1 << max(16, (n - 1).bit_length())
    if size in _POWERS:
        return _POWERS[size]
    up = np.full(size, BASE, np.uint64)
    down = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    made = np.multiply.accumulate(up), np.multiply.accumulate(down)
    if size <= 4 * SLICE_BYTES:
        _POWERS[size] = made
    return made


class SpanHash:
    """64-bit hashes of any spans of a byte array in constant time each; equal bytes have equal hashes."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_CODES[data] * up[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def separators() -> np.ndarray:
    """True for the byte values between words: space and 0x09 to 0x0D."""
    table = np.zeros(256, bool)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return table


SEPARATORS = separators()


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word: a longest run of bytes that are no separators, within one text."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~SEPARATORS[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] = solid[inner]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[inner - 1] = solid[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def per_row(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, weights, minlength=n) if weights is not None else np.bincount(rows, minlength=n)
