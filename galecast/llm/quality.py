"""Quality rules: plain counts, then compression bands.

A text that repeats itself compresses too well, noise too badly. The zstandard ratio (compressed / raw bytes) is taken of the
whole text and of fixed chunks; what is normal depends on the length, so each length has its own band, and a chunk, the
shorter last one included, is judged by the band of its own length. A text fails if its whole ratio leaves its band, or if
more than `bad_share` of its bytes lie in chunks that do.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from galecast.llm.text import passes, per_text, texts, window_hashes, window_starts, word_hashes, words

#: From this many bytes on (first entry), the least and the greatest ratio that natural prose reaches.
BANDS = (
    (0, 0.0, 2.0),
    (64, 0.62, 1.25),
    (128, 0.56, 1.05),
    (256, 0.54, 0.86),
    (512, 0.47, 0.79),
    (1024, 0.435, 0.70),
    (2048, 0.42, 0.64),
    (4096, 0.395, 0.60),
    (8192, 0.38, 0.57),
    (16384, 0.36, 0.55),
    (32768, 0.33, 0.54),
    (131072, 0.28, 0.54),
)
LEVEL = 3
CHUNK_BYTES = 2048
BAD_SHARE = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WORDS = 5
COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "ratio double, bad_chunk_share double, band string, kept boolean"
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
#: First bytes of the code points that belong to words.
_LETTER = (np.arange(256) & 0xC0) != 0x80
_LETTER[[9, 10, 11, 12, 13, 32]] = False


class Bands(NamedTuple):
    low: np.ndarray
    high: np.ndarray
    floor: np.ndarray

    def outside(self, size: np.ndarray, ratio: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.floor, size, side="right") - 1
        return np.where(ratio < self.low[at], -1, np.where(ratio > self.high[at], 1, 0))


def bands(table: tuple = BANDS) -> Bands:
    return Bands(*(np.array([row[i] for row in table], float) for i in (1, 2, 0)))


def repeated_words(hashes: np.ndarray, bounds: np.ndarray, k: int = REPEAT_WORDS) -> np.ndarray:
    """For each text, its words in k-word windows that occur twice or more in it, the first occurrence included."""
    n = int(bounds[-1])
    at = window_starts(bounds, k)
    if not len(at):
        return np.zeros(len(bounds) - 1, np.int64)
    row = (np.searchsorted(bounds, at, side="right")).astype(np.uint64)
    key = window_hashes(hashes, k)[at] ^ (row * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    step = np.zeros(n + 1, np.int32)
    step[at[twice]] += 1
    step[at[twice] + k] -= 1
    return per_text(np.cumsum(step[:-1]) > 0, bounds)


def flagged(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text are flagged, without running sums over the bytes."""
    return np.array([np.count_nonzero(flags[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.int64)


def repeated_lines(text: bytes) -> int:
    """Lines (split at line feeds) with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines)) if len(lines) > 1 else 0


def compression(text: bytes, pack: zstandard.ZstdCompressor, limits: Bands, chunk: int) -> tuple[float, float, int]:
    """Whole ratio, share of bytes in chunks outside their band, and the side on which the whole text leaves its band."""
    if not text:
        return 0.0, 0.0, 0
    whole = len(pack.compress(text)) / len(text)
    side = int(limits.outside(np.array([len(text)]), np.array([whole]))[0])
    if len(text) <= chunk:
        return whole, float(side != 0), side
    size = np.full(-(-len(text) // chunk), chunk)
    size[-1] = len(text) - chunk * (len(size) - 1)
    packed = np.array([len(pack.compress(text[i : i + chunk])) for i in range(0, len(text), chunk)])
    bad = limits.outside(size, packed / size) != 0
    return whole, float(size[bad].sum() / len(text)), side


def measure(column: pa.Array, table: tuple = BANDS, chunk: int = CHUNK_BYTES, bad_share: float = BAD_SHARE) -> list[pa.Array]:
    """The columns of COLUMNS for one slice of texts."""
    data, offsets = texts(column)
    starts, ends, bounds = words(data, offsets)
    n_words = np.diff(bounds)
    chars = flagged(_LETTER[data], offsets)
    symbols = flagged(_SYMBOL[data], offsets)
    repeats = repeated_words(word_hashes(data, starts, ends), bounds)
    pack, limits, raw = zstandard.ZstdCompressor(level=LEVEL), bands(table), data.tobytes()
    rows = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    lines = [repeated_lines(row) for row in rows]
    ratio, bad, side = (np.array(x) for x in zip(*(compression(row, pack, limits, chunk) for row in rows), strict=True))
    base = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
    band = np.array(["repetitive", "normal", "noise"], object)[side + 1]
    band[(side == 0) & (bad > bad_share)] = "chunks"
    values = (n_words, chars, symbols, np.array(lines, np.int64), repeats, base, ratio, bad)
    return [pa.array(x) for x in (*values, band, ~base & (band == "normal"))]


def with_quality(docs: DataFrame, text: str = "text", table: tuple = BANDS, chunk: int = CHUNK_BYTES, bad_share: float = BAD_SHARE) -> DataFrame:
    """Every row of docs with the columns of COLUMNS; a column of such a name in docs is replaced.

    A null or empty text has no words, ratio 0 and fails. Rows are judged alone: repeated rows get equal verdicts, an empty
    table gives an empty result. No shuffle.
    """
    added = [part.split()[0] for part in COLUMNS.split(", ")]
    kept = [name for name in docs.columns if name not in added]
    docs = docs.select(*(F.col(f"`{name}`") for name in kept))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch, text):
                yield pa.RecordBatch.from_arrays([*part.columns, *measure(part.column(text), table, chunk, bad_share)], names=[*kept, *added])

    return docs.mapInArrow(judge, StructType([*docs.schema.fields, *StructType.fromDDL(COLUMNS).fields]))


def rejected_removed(docs: DataFrame) -> DataFrame:
    """The rows of docs that pass, with the columns of docs, whatever their names are."""
    at, verdict = docs.columns.index("text"), [part.split()[0] for part in COLUMNS.split(", ")].index("kept")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.RecordBatch.from_arrays([batch.column(0).field(at)], names=["text"])
            first = 0
            for part in passes(text):
                yield batch.slice(first, part.num_rows).filter(measure(part.column(0))[verdict])
                first += part.num_rows

    rows = docs.select(F.struct("*").alias("row"))
    return rows.mapInArrow(judge, rows.schema).select("row.*")
