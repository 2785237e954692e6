"""Exact repeated passages by fixed-block anchors.

A passage of WINDOW words that occurs in two documents covers, wherever it starts, a whole block of the grid of ANCHOR words that is
laid over the first document (WINDOW >= 2 * ANCHOR - 1). So the non-overlapping blocks of all documents are indexed by hash, and
every rolling window of ANCHOR words probes the index. A hit is extended: each window of WINDOW words around it, on both sides, is
looked up by 96 bits of its own hash, and the least doc_id that holds it comes back. Neighbouring windows that are confirmed
make up a maximal exact repeat, whatever its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galecast.llm.chunks import ASKED, Chunk, Question, answer, apply, ask, bucket_bits, chunked, questions
from galecast.llm.text import covered, mix, per_text, window_hashes, window_starts

WINDOW = 50
#: A probe is sent with so many bits more than it takes to number all blocks, so that one in 2^18 probes at most meets a foreign
#: block by chance; such a hit is refused when it is extended.
SPARE_BITS = 18
#: Stands for a null doc_id, which takes no part.
_NO_ID = np.uint64(0)
_FLIP = np.uint64(1 << 63)
SPANS = "doc_id long, n_words long, n_removed long, kept_text string, spans array<struct<first:long,words:long>>"


def _probes(chunk: Chunk, hashes: np.ndarray, anchor: int, window: int, size_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling windows of documents long enough to hold a repeat: position of the first word, and truncated hash."""
    at = window_starts(chunk.bounds, anchor)
    size = np.diff(chunk.bounds)
    doc = np.searchsorted(chunk.bounds, at, side="right") - 1
    at = at[size[doc] >= window]
    key = window_hashes(hashes, anchor)[at] if len(at) else np.zeros(0, np.uint64)
    return at, key >> np.uint64(64 - size_bits) << np.uint64(64 - size_bits)


def _order(chunk: Chunk) -> np.ndarray:
    """Each document's id as an unsigned number in the same order; a null doc_id takes no part."""
    column = chunk.rows.column("doc_id").cast(pa.int64())
    ids = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ _FLIP
    return np.where(column.is_null().to_numpy(zero_copy_only=False), _NO_ID, ids)


def block_question(window: int, probe_bits: int):
    anchor = (window + 1) // 2

    def question(chunk: Chunk) -> Question:
        """Number of a key: its occurrences among the chunk's probes (2 stands for more), and 2^32 if one of them is a block."""
        at, key = _probes(chunk, chunk.hashes(), anchor, window, probe_bits)
        doc = np.searchsorted(chunk.bounds, at, side="right") - 1
        block = (at - chunk.bounds[doc]) % anchor == 0
        keys, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        is_block = np.zeros(len(keys), bool)
        is_block[inverse[block]] = True
        return Question(keys, np.minimum(count, 2).astype(np.uint64) + (is_block.astype(np.uint64) << np.uint64(32)))

    return question


def block_hits(values: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key hits if it is a block and occurs elsewhere too."""
    total = np.add.reduceat(values, runs)
    return np.zeros(len(runs), np.uint64), ((total & np.uint64(0xFFFFFFFF)) >= 2) & (total >> np.uint64(32) > 0)


def _is_in(keys: np.ndarray, known: np.ndarray | None) -> np.ndarray:
    if known is None or not len(known):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(known, keys)
    return known[np.minimum(at, len(known) - 1)] == keys


def _windows(hashes: tuple[np.ndarray, np.ndarray], window: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key and tag of the windows at some positions; each comes from a word hash of its own."""
    key, tag = window_hashes(hashes[0], window)[at], window_hashes(hashes[1], window, 1)[at]
    return key, tag >> np.uint64(32)


def window_question(window: int, probe_bits: int, bits: int):
    anchor = (window + 1) // 2

    def use(number: int, chunk: Chunk, told: Question) -> pa.Table:
        """Asks for the windows around the hits, with the least id that holds them in this chunk."""
        hashes = chunk.hashes(both=True)
        at, key = _probes(chunk, hashes[0], anchor, window, probe_bits)
        hit = at[_is_in(key, told.keys)]
        starts = window_starts(chunk.bounds, window)
        reach = window - anchor
        near = covered(hit, reach + 1, len(hashes[0]) + reach)[starts + reach] if len(hit) else np.zeros(len(starts), bool)
        starts = starts[near]
        ids = _order(chunk)[np.searchsorted(chunk.bounds, starts, side="right") - 1]
        starts, ids = starts[ids != _NO_ID], ids[ids != _NO_ID]
        if not len(starts):
            return questions(number, Question(*[np.zeros(0, np.uint64)] * 3), bits)
        key, tag = _windows(hashes, window, starts)
        order = np.lexsort((ids, tag, key))
        key, tag, ids = key[order], tag[order], ids[order]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (tag[1:] != tag[:-1])])
        last = np.append(fresh[1:], True) & (ids != ids[fresh][np.cumsum(fresh) - 1])
        asked = fresh | last  # the least id, and the greatest where the chunk holds several
        return questions(number, Question(key[asked], ids[asked], tag[asked]), bits)

    return use


def least_owner(values: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least id that holds a window, told for the windows of several documents."""
    least = np.minimum.reduceat(values, runs)
    return least, least < np.maximum.reduceat(values, runs)


def removal(window: int):
    def use(number: int, chunk: Chunk, told: Question) -> pa.Table:
        """Removes each word under a window that a document with a smaller id holds."""
        n, size = len(chunk.starts), np.diff(chunk.bounds)
        gone = np.zeros(n, bool)
        starts = window_starts(chunk.bounds, window)
        if told.keys is not None and len(starts):
            hashes = chunk.hashes(both=True)
            key, tag = _windows(hashes, window, starts)
            some = _is_in(key, told.keys)
            key, tag, starts = key[some], tag[some], starts[some]
            both = mix(told.keys) ^ told.tags
            order = np.argsort(both)
            at = order[np.minimum(np.searchsorted(both[order], mix(key) ^ tag), len(order) - 1)]
            ids = _order(chunk)[np.searchsorted(chunk.bounds, starts, side="right") - 1]
            owned = (told.keys[at] == key) & (told.tags[at] == tag) & (told.values[at] < ids)
            gone = covered(starts[owned], window, n)
        raw, kept, spans = chunk.data.tobytes(), [], []
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        runs = [(a, b) for a, b in edges.reshape(-1, 2)] if len(edges) else []
        inner = np.searchsorted([a for a, _ in runs], chunk.bounds)
        for i, (a, b) in enumerate(zip(chunk.bounds[:-1], chunk.bounds[1:], strict=True)):
            stay = np.flatnonzero(~gone[a:b]) + a
            kept.append(" ".join(raw[s:e].decode() for s, e in zip(chunk.starts[stay].tolist(), chunk.ends[stay].tolist(), strict=True)))
            mine = []
            j, low = inner[i], a
            if j and runs[j - 1][1] > a:
                mine.append({"first": 0, "words": int(min(runs[j - 1][1], b) - a)})
            for first, end in runs[j : inner[i + 1]]:
                mine.append({"first": int(first - low), "words": int(min(end, b) - first)})
            spans.append(mine)
        removed = per_text(gone, chunk.bounds)
        spans_type = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))
        return pa.table({"doc_id": chunk.rows.column("doc_id"), "n_words": size.astype(np.int64), "n_removed": removed.astype(np.int64), "kept_text": pa.array(kept, pa.string()), "spans": pa.array(spans, spans_type)})

    return use


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by a space) and spans (removed runs of words) of every row of docs.

    A word goes if it lies in a window of `window` words that also starts in a document with a smaller doc_id; windows are judged
    on the texts as they came. A null text has no words; a row without doc_id is neither trimmed nor trims others; rows with
    equal doc_ids do not trim each other. An empty table gives an empty result.
    """
    chunks = chunked(docs.select(F.col("doc_id").cast("long"), "text"), "passages")
    bits, total = bucket_bits(chunks)
    probe_bits = min((total // ((window + 1) // 2)).bit_length() + SPARE_BITS, 64)
    hits = answer(ask(chunks, block_question(window, probe_bits), bits), block_hits)
    windows = apply(chunks, hits, window_question(window, probe_bits, bits), ASKED)
    return apply(chunks, answer(windows, least_owner), removal(window), SPANS)


def repeated_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))

