"""Best-fit packing of token sequences with large-item matching.

Documents are encoded, closed with an end id and cut into pieces of the capacity at most. Pieces of equal length are alike, so the bins are
planned on the counts by length alone, at most one number for each length: pieces above a third of the capacity, of which a bin holds two at
most, are matched greedily, the largest with the largest that still fits; the others, by falling length, go to the bins whose gap fits best. The
plan is a list of runs: pieces of one length, by rank, into consecutive bins. A run that takes up a bin leaves less than half of the gap,
so a bin is touched once for each bit of the capacity and the list stays short, however many documents there are. Every piece then finds
its run by its rank among the pieces of its length, and moves to its sequence in one shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galecast.llm.shared import stored
from galecast.llm.text import passes
from galecast.llm.tokens import encoder, vocabulary

CAPACITY = 2048
#: Closes every document.
END_ID = 0
#: Ranks of pieces are below 2 ** RANK_BITS.
RANK_BITS = 44
PIECES = "doc_id long, piece int, start long, length int, ids binary, part int, nth long"
SEQUENCES = "sequence_id long, ids binary, doc_ids array<long>, pieces array<int>, starts array<long>, lengths array<int>"
DIGESTS = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class Run(NamedTuple):
    """Pieces of a length from rank `first` on: `each` to a bin, one behind the other from `offset` on, in bins from `sequence` on."""

    length: int
    first: int
    count: int
    sequence: int
    each: int
    offset: int


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Run]:
    """The runs that pack so many pieces of each length (1 to capacity)."""
    left = {length: n for length, n in counts.items() if n}
    used = dict.fromkeys(left, 0)
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    is_open = bytearray(capacity + 1)
    runs: list[Run] = []
    bins = 0

    def put(length: int, n: int, sequence: int, each: int, offset: int) -> None:
        runs.append(Run(length, used[length], n, sequence, each, offset))
        used[length] += n
        left[length] -= n

    def leave(gap: int, sequence: int, n: int) -> None:
        if gap and n:
            gaps[gap].append((sequence, n))
            is_open[gap] = 1

    large = sorted((length for length in left if 3 * length > capacity), reverse=True)
    waiting = bytearray(capacity + 1)
    for length in large:
        waiting[length] = 1
    for length in large:
        while left[length]:
            if left[length] == 1:
                waiting[length] = 0
            other = waiting.rfind(1, 0, capacity - length + 1)
            if other == length:
                n = left[length] // 2
            else:
                n = left[length] if other < 0 else min(left[length], left[other])
            put(length, n, bins, 1, 0)
            if other >= 0:
                put(other, n, bins, 1, length)
                waiting[other] = left[other] > 0
            leave(capacity - length - max(other, 0), bins, n)
            bins += n
        waiting[length] = 0
    for length in sorted((length for length in left if 3 * length <= capacity), reverse=True):
        while left[length]:
            gap = is_open.find(1, length)
            if gap < 0:
                n = -(-left[length] // (capacity // length))
                leave(capacity, bins, n)
                bins += n
                continue
            sequence, n = gaps[gap].pop()
            is_open[gap] = len(gaps[gap]) > 0
            each = gap // length
            full = min(n, left[length] // each)
            if full:
                put(length, full * each, sequence, each, capacity - gap)
                leave(gap - each * length, sequence, full)
            if full < n and 0 < left[length] < each:
                some = left[length]
                put(length, some, sequence + full, some, capacity - gap)
                leave(gap - some * length, sequence + full, 1)
                full += 1
            leave(gap, sequence + full, n - full)
    return runs


def width(path: str, end: int) -> np.dtype:
    """The integers that hold every id of a vocabulary while pieces are moved: of two bytes where they can."""
    return np.dtype("<u2" if max(encoder(path).tokenizer.get_vocab_size(), end + 1) <= 1 << 16 else "<u4")


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END_ID) -> DataFrame:
    """The stored pieces of docs (doc_id, text): their ids (see width), where they start in their document, and their number (nth) among the
    pieces of their length in their part of the table."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        number, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows in passes(batch):
                ids, size = code.encode(rows.column("text"), end)
                pieces = -(-size // capacity)
                doc = np.repeat(np.arange(len(size)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(size[doc] - start, capacity)
                order = np.argsort(length, kind="stable")
                fresh = np.concatenate([[True], np.diff(length[order]) > 0])
                run = np.flatnonzero(fresh)
                nth = np.empty(len(doc), np.int64)
                nth[order] = np.arange(len(doc)) - run[np.cumsum(fresh) - 1] + seen[length[order]]
                seen += np.bincount(length, minlength=capacity + 1)
                bounds = np.concatenate([[0], np.cumsum(length)]).astype(np.int64) * kind.itemsize
                data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(bounds), pa.py_buffer(ids.astype(kind))])
                columns = [
                    rows.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length, pa.int32()),
                    data.cast(pa.binary()), pa.array(np.full(len(doc), number), pa.int32()), pa.array(nth),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[name.split()[0] for name in PIECES.split(", ")])
        code.forget()

    kind = width(path, end)
    slim = docs.select(F.col("doc_id").cast("long"), "text")
    return stored(slim.mapInArrow(encode, PIECES), "pieces", **{"parquet.block.size": str(32 << 20)})


def assigned(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset instead of part and nth.

    The driver sees the counts by length, `capacity` numbers at most. What lies before a part is one number for each part and length, joined.
    """
    tallies = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    tallies = stored(tallies, "tallies")
    counts = {row["length"]: row["n"] for row in tallies.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = sorted(plan(counts, capacity))
    key = np.array([run.length << RANK_BITS | run.first for run in runs], np.int64)
    sequence, each, offset, first = (np.array([getattr(run, name) for run in runs], np.int64) for name in ("sequence", "each", "offset", "first"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(tallies.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "ranks")
    ranked = pieces.join(starts, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids", (F.col("nth") + F.col("before")).alias("rank"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(name).to_numpy().astype(np.int64) for name in ("length", "rank"))
            at = np.searchsorted(key, length << RANK_BITS | rank, side="right") - 1
            inside = rank - first[at]
            places = [pa.array(sequence[at] + inside // each[at]), pa.array(offset[at] + inside % each[at] * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *places], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(assign, "doc_id long, piece int, start long, length int, ids binary, sequence_id long, offset long")


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END_ID) -> DataFrame:
    """The stored sequences of docs (doc_id, text): ids and, in their order, the pieces they are made of.

    A null text is an empty one: its document is the end id alone. Repeated rows are documents of their own; a null doc_id stays null;
    other columns do not count. A text of any length is cut, so no bin and no row of the result is above the capacity. An empty table
    gives an empty result.
    """
    path = path or vocabulary()
    kind = width(path, end)
    placed = assigned(cut(docs, path, capacity, end), capacity)
    ordered = placed.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            ids = table.column("sequence_id").to_numpy()
            edge = int(np.searchsorted(ids, ids[-1])) if len(ids) else 0
            held = table.slice(edge)
            if edge:
                yield whole(table.slice(0, edge))
        if held is not None and len(held):
            yield whole(held)

    def whole(table: pa.Table) -> pa.RecordBatch:
        rows = table.combine_chunks().to_batches()[0]
        sequence = rows.column("sequence_id").to_numpy()
        first = np.flatnonzero(np.concatenate([[True], np.diff(sequence) > 0]))
        edges = np.append(first, len(sequence)).astype(np.int32)
        size = np.concatenate([[0], np.cumsum(rows.column("length").to_numpy().astype(np.int64))])
        bounds = (size[edges] * 4).astype(np.int64)
        ids = np.frombuffer(b"".join(rows.column("ids").to_pylist()), kind).astype("<u4")
        data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(ids)])
        lists = [pa.ListArray.from_arrays(pa.array(edges), rows.column(name)) for name in ("doc_id", "piece", "start", "length")]
        return pa.RecordBatch.from_arrays([pa.array(sequence[first]), data.cast(pa.binary()), *lists], names=[name.split()[0] for name in SEQUENCES.split(", ")])

    return stored(ordered.mapInArrow(join, SEQUENCES), "sequences", **{"parquet.block.size": str(32 << 20)})


def pieces_of(sequences: DataFrame) -> DataFrame:
    """The columns of DIGESTS, one row a piece, read from the sequences."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {name: batch.column(name) for name in batch.schema.names}
            count = column["lengths"].value_lengths().to_numpy()
            length = column["lengths"].flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(count)), count)
            before = np.cumsum(length) - length
            offset = before - np.repeat(before[np.cumsum(count) - count], count)
            raw = [memoryview(value.as_buffer()) for value in column["ids"]]
            crc = [zlib.crc32(raw[i][4 * a : 4 * b]) for i, a, b in zip(row.tolist(), offset.tolist(), (offset + length).tolist(), strict=True)]
            columns = [
                column["doc_ids"].flatten(), column["pieces"].flatten(), column["starts"].flatten(), pa.array(length), pa.array(crc, pa.int64()),
                column["sequence_id"].take(pa.array(row)), pa.array(offset),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[name.split()[0] for name in DIGESTS.split(", ")])

    return sequences.mapInArrow(read, DIGESTS)


def packed_documents(docs: DataFrame) -> DataFrame:
    """The columns of DIGESTS for every piece of the documents."""
    return pieces_of(packed(docs))
