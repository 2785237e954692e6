"""Words, word hashes and window hashes of whole Arrow batches, and small helpers shared by the operators.

A word is a maximal run of code points outside space, tab, line feed, vertical tab, form feed and carriage return. All of
these are ASCII, so words are found on the UTF-8 bytes of a batch at once; a missing text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from galecast.llm.shared import ship

#: The word pattern for SQL and regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one numpy pass covers; a longer single text is a pass of its own.
PASS_BYTES = 2 << 20
#: Words whose window hashes one numpy pass computes.
BLOCK_WORDS = 1 << 17
#: White space among the bytes.
GAP = np.zeros(256, bool)
GAP[[9, 10, 11, 12, 13, 32]] = True
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A driver table, read as it is."""
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the byte offset of each row; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def passes(batch: pa.RecordBatch, column: str = "text", limit: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of at most `limit` bytes of text (a longer text alone)."""
    _, offsets = texts(batch.column(column))
    first, rows = 0, batch.num_rows
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield batch.slice(first, last - first)
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of words before each text (one more entry for the total)."""
    inside = ~GAP[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1] | cut[1:-1]
        ends[:-1] &= ~inside[1:] | cut[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (wraps around on purpose)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number modulo 2^64, and of its inverse; those of one block are remembered."""
    if n > BLOCK_WORDS + 1 or base not in _POWERS:
        both, size = [], max(n, BLOCK_WORDS + 1)
        for step in (_ODD[base], pow(_ODD[base], -1, 1 << 64)):
            x = np.full(size, step, np.uint64)
            x[0] = 1
            both.append(np.cumprod(x, dtype=np.uint64))
        if n > BLOCK_WORDS + 1:
            return both[0], both[1]
        _POWERS[base] = (both[0], both[1])
    return _POWERS[base]


def _sums(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    power, inverse = _powers(len(values) + 1, base)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return total, inverse


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, both: bool = False) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word's bytes, or two that do not depend on each other: the halves of XXH3's 128 bits."""
    first, second = np.empty(len(starts), np.uint64), np.empty(len(starts) if both else 0, np.uint64)
    low = 0
    while low < len(starts):
        high = max(int(np.searchsorted(ends, starts[low] + PASS_BYTES, side="right")), low + 1)
        raw = data[starts[low] : ends[high - 1]].tobytes()
        spans = zip((starts[low:high] - starts[low]).tolist(), (ends[low:high] - starts[low]).tolist(), strict=True)
        digests = b"".join([xxhash.xxh3_128_digest(raw[a:b]) for a, b in spans])
        halves = np.frombuffer(digests, "<u8").reshape(-1, 2)
        first[low:high] = halves[:, 0]
        if both:
            second[low:high] = halves[:, 1]
        low = high
    return (first, second) if both else first


def window_hashes(hashes: np.ndarray, k: int, base: int = 0) -> np.ndarray:
    """A 64-bit hash of every k consecutive words, by position of the first; windows may span texts."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    step = BLOCK_WORDS - k + 1 if k < BLOCK_WORDS else BLOCK_WORDS
    for first in range(0, n, step):
        part = hashes[first : first + step + k - 1]
        total, inverse = _sums(part, base)
        m = len(part) - k + 1
        out[first : first + m] = (total[k : k + m] - total[:m]) * inverse[:m]
    return mix(out)


def window_starts(bounds: np.ndarray, k: int) -> np.ndarray:
    """Positions whose k words lie within one text; bounds: words before each text."""
    ok = np.zeros(bounds[-1] + 1, np.int32)
    low, high = bounds[:-1], np.maximum(bounds[1:] - k + 1, bounds[:-1])
    np.add.at(ok, low, 1)
    np.add.at(ok, high, -1)
    return np.flatnonzero(np.cumsum(ok[:-1]) > 0)


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of n positions lie in [s, s + k) for a start s (no start twice)."""
    step = np.zeros(n + k + 1, np.int32)
    step[starts] += 1
    step[starts + k] -= 1
    return np.cumsum(step)[:n] > 0


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of a value by word for each text."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[bounds[1:]] - total[bounds[:-1]]
