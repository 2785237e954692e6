"""Lookups of hashed n-grams across a whole corpus, in chunks of documents.

A corpus is stored once as chunks: rows that hold some MB of documents, compressed. A chunk asks with its distinct keys (64-bit
hashes) and one number for each, sorted, cut by the top bits of the key into buckets. A bucket meets in one task, which reduces the
numbers of equal keys and answers each chunk; the answers go back to the chunk, which is decoded again and applies them to every
position. What is shuffled is one entry for each distinct key of a chunk, so a key that is on every line is pre-aggregated to one
entry a chunk, and no pair of documents is ever formed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galecast.llm.shared import stored
from galecast.llm.text import passes, texts, word_hashes, words

#: Bytes of text in a chunk (a longer document is a chunk of its own), and words that meet in a bucket on average.
CHUNK_BYTES = 6 << 20
BUCKET_WORDS = 1 << 19
#: Buckets are a power of two, this at least; their number follows the words, so no bucket grows with the corpus.
LEAST_BUCKETS = 16


def squeeze(values: np.ndarray) -> bytes:
    """Unsigned 64-bit integers as compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.compress(planes.tobytes(), 1)


def expand(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.uint64)


def squeeze_sorted(values: np.ndarray) -> bytes:
    return squeeze(np.diff(values, prepend=np.uint64(0)))


def expand_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(expand(packed), dtype=np.uint64)


class Chunk(NamedTuple):
    rows: pa.RecordBatch
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def hashes(self, both: bool = False) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
        return word_hashes(self.data, self.starts, self.ends, both)


def unpacked(blob: bytes) -> Chunk:
    rows = pa.ipc.open_stream(pa.BufferReader(blob)).read_all().combine_chunks().to_batches()[0]
    data, offsets = texts(rows.column("text"))
    return Chunk(rows, data, *words(data, offsets))


def chunked(docs: DataFrame, name: str, size: int = CHUNK_BYTES) -> DataFrame:
    """chunk, words, blob: docs (text and other columns) in stored chunks; chunk numbers are unique in the table."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, bytes_ = [], 0
        options = pa.ipc.IpcWriteOptions(compression="zstd")

        def out() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=options) as stream:
                stream.write_table(rows)
            chunk = unpacked(blob := sink.getvalue().to_pybytes())
            return pa.RecordBatch.from_pydict({"chunk": pa.array([number]), "words": pa.array([len(chunk.starts)]), "blob": pa.array([blob], pa.binary())})

        for batch in batches:
            for part in passes(batch):
                more = len(texts(part.column("text"))[0])
                if held and bytes_ + more > size:
                    yield out()
                    number, held, bytes_ = number + 1, [], 0
                held.append(part)
                bytes_ += more
        if held:
            yield out()

    return stored(docs.mapInArrow(pack, "chunk long, words long, blob binary"), name, compression="none", **{"parquet.block.size": str(32 << 20)})


def bucket_bits(chunks: DataFrame) -> tuple[int, int]:
    """Bits of the key that choose the bucket, and the words of all chunks."""
    total = chunks.agg(F.sum("words")).first()[0] or 0
    buckets = max(total // BUCKET_WORDS, LEAST_BUCKETS)
    return int(buckets - 1).bit_length(), int(total)


class Question(NamedTuple):
    """Distinct keys in ascending order (keys, then tags where there are any) with a number for each."""

    keys: np.ndarray
    values: np.ndarray
    tags: np.ndarray | None = None


ASKED = "bucket int, chunk long, keys binary, tags binary, numbers binary"
ANSWERED = "chunk long, bucket int, keys binary, tags binary, numbers binary"


def questions(chunk: int, asked: Question, bits: int) -> pa.Table:
    """One row for each bucket that the keys touch."""
    at, first = np.unique(asked.keys >> np.uint64(64 - bits), return_index=True)
    edge = [*first.tolist(), len(asked.keys)]
    cut = lambda values, how: [how(values[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)]
    tags = cut(asked.tags, squeeze) if asked.tags is not None else [None] * len(at)
    columns = [at.astype(np.int32), [chunk] * len(at), cut(asked.keys, squeeze_sorted), tags, cut(asked.values, squeeze)]
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.table({name.split()[0]: pa.array(x, kind) for name, x, kind in zip(ASKED.split(", "), columns, kinds, strict=True)})


def ask(chunks: DataFrame, question: Callable[[Chunk], Question], bits: int) -> DataFrame:
    """The questions of all chunks."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob"), strict=True):
                yield from questions(number, question(unpacked(blob.as_buffer())), bits).to_batches()

    return chunks.select("chunk", "blob").mapInArrow(each, ASKED)


def answer(asked: DataFrame, reduce: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Answers to each chunk. reduce(values, starts of runs of equal keys) gives a number for each run, and which runs to tell."""

    def meet(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        keys = [expand_sorted(x) for x in rows["keys"]]
        size = np.cumsum([0] + [len(x) for x in keys])
        key = np.concatenate(keys)
        value = np.concatenate([expand(x) for x in rows["numbers"]])
        tag = np.concatenate([expand(x) for x in rows["tags"]]) if rows["tags"][0] is not None else None
        order = np.argsort(key, kind="stable") if tag is None else np.lexsort((tag, key))
        sorted_ = key[order]
        fresh = np.concatenate([[True], sorted_[1:] != sorted_[:-1]])
        if tag is not None:
            fresh[1:] |= tag[order][1:] != tag[order][:-1]
        number, tell = reduce(value[order], np.flatnonzero(fresh))
        run = np.empty(len(key), np.int64)
        run[order] = np.cumsum(fresh) - 1
        out = {name.split()[0]: [] for name in ANSWERED.split(", ")}
        for i, (a, b) in enumerate(zip(size[:-1], size[1:], strict=True)):
            mine = np.flatnonzero(tell[run[a:b]]) + a
            if len(mine):
                out["chunk"].append(rows["chunk"][i])
                out["bucket"].append(rows["bucket"][i])
                out["keys"].append(squeeze_sorted(key[mine]))
                out["tags"].append(None if tag is None else squeeze(tag[mine]))
                out["numbers"].append(squeeze(number[run[mine]]))
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table({name: pa.array(x, kind) for (name, x), kind in zip(out.items(), kinds, strict=True)})

    return asked.groupBy("bucket").applyInArrow(meet, ANSWERED)


def apply(chunks: DataFrame, answers: DataFrame, use: Callable[[int, Chunk, Question], pa.Table], schema: str) -> DataFrame:
    """What `use` makes of each chunk and the answers to it (keys None where there are none). Every chunk is used."""

    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("bucket").to_pydict()
        join = lambda name, how: np.concatenate([how(x) for x in right[name]]) if right[name] and right[name][0] is not None else None
        told = Question(join("keys", expand_sorted), join("numbers", expand), join("tags", expand))
        return use(left.column("chunk")[0].as_py(), unpacked(left.column("blob").chunk(0)[0].as_buffer()), told)

    return chunks.select("chunk", "blob").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(each, schema)
