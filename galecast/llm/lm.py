"""Language-model scores with stupid backoff, from n-gram counts of the whole corpus.

An n-gram that the corpus holds scores count(n-gram) / count(its context); otherwise BACKOFF times the score of the n-gram without
its first word, down to count(word) / all words; a word that the corpus lacks scores as one in all words and one. The counts
that a document is scored with leave its own n-grams out, or every n-gram would be known.

As relations: documents lie in blocks of a few MB, as hashes of their words, in a table bucketed by block, so that no step sends them
again. `grams` holds one row (gram, block, n) for each distinct n-gram of a block; it is partitioned by the hash of the n-gram, and
the count table (gram, total), grouped in these partitions, is joined to it there. Only n-grams that two blocks hold go back to their
blocks; of the others a block knows the count itself. This is done for one order after the other, since an n-gram can be in two
blocks only if its first and its last n - 1 words are: no other n-gram is sent. What comes back of an order is stored, and Spark
removes the files of its exchange. At last a block takes the logarithms of its positions and sums them by document. An n-gram on
every line is one row a block.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galecast.llm.shared import folder, stored
from galecast.llm.text import GAP, PASS_BYTES, mix, passes, per_text, texts, window_hashes, word_hashes, words

ORDER = 3
BACKOFF = 0.4
SCORES = "n_words long, log_score double, mean_log_score double, perplexity double, n_backed_off long"
#: Bytes of text in a block of documents; a longer document is a block of its own.
BLOCK_BYTES = 12 << 20
#: Rows of n-grams in an Arrow batch.
BATCH_ROWS = 1 << 18
GRAMS = pa.schema([("gram", pa.int64()), ("block", pa.int64()), ("n", pa.int64())])
#: Hashes of the distinct words of a file of blocks.
DICTIONARY_BYTES = 16 << 20
#: Words of a corpus from which its longer n-grams and its blocks are exchanged in SLICES jobs, one after the other.
LARGE_WORDS, SLICES = 1 << 22, 3
#: Spark removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Block(NamedTuple):
    """Word hashes of some documents, and the number of words before each document."""

    hashes: np.ndarray
    bounds: np.ndarray


def word_lists(column: pa.Array) -> pa.ListArray:
    """The word hashes of each text. Each distinct word of the column is hashed once."""
    data, offsets = texts(column)
    starts, ends, bounds = words(data, offsets)
    ends_ = np.concatenate([[0], np.cumsum(ends - starts)])
    letters = data[~GAP[data]]
    apart = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends_), pa.py_buffer(letters)]).dictionary_encode()
    _, cuts, held = apart.dictionary.buffers()
    cuts = np.frombuffer(cuts, np.int64)[: len(apart.dictionary) + 1] if len(starts) else np.zeros(1, np.int64)
    hashes = word_hashes(np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8), cuts[:-1], cuts[1:])
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(hashes[apart.indices.to_numpy()].view(np.int64)))


def block_of(column: pa.ChunkedArray) -> Block:
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).astype(np.int64)
    return Block(lists.flatten().to_numpy().view(np.uint64), bounds)


def gram_keys(hashes: np.ndarray, n: int) -> np.ndarray:
    """A key for the n-gram that starts at each word; the order is part of it."""
    return mix(window_hashes(hashes, n) + np.uint64(n))


def _positions(block: Block, n: int) -> np.ndarray:
    """Where an n-gram of one document starts."""
    doc = np.repeat(np.arange(len(block.bounds) - 1), np.diff(block.bounds))
    m = max(len(doc) - n + 1, 0)
    return np.flatnonzero(doc[:m] == doc[n - 1 : n - 1 + m])


def gram_counts(block: Block, order: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a block from one order up to another, ascending, and how often it holds each."""
    keys, counts = np.unique(np.concatenate([gram_keys(block.hashes, n)[_positions(block, n)] for n in range(least, order + 1)]), return_counts=True)
    return keys, counts.astype(np.int64)


def in_blocks(docs: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """docs with the columns _block, _words (words of the text) and _hashes (of the words) for the text, in a stored table bucketed by _block."""
    spark = docs.sparkSession
    kept = [f for f in docs.schema if f.name != "text"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in passes(batch, limit=min(size, PASS_BYTES)):
                bytes_ = int(texts(part.column("text"))[1][-1])
                if held and held + bytes_ > size:
                    number, held = number + 1, 0
                held += bytes_
                lists = word_lists(part.column("text"))
                columns = [*(part.column(f.name) for f in kept), pa.array(np.full(part.num_rows, number)), pc.list_value_length(lists).cast(pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in kept), "_block", "_words", "_hashes"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "_block long, _words long, _hashes array<long>"])
    name = f"blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    written = docs.mapInArrow(deal, schema).write.bucketBy(buckets, "_block").sortBy("_block")
    written.options(**{"compression": "zstd", "parquet.dictionary.page.size": str(DICTIONARY_BYTES)}).option("path", f"{folder(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def _gram_rows(keys: np.ndarray, number: int, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    block = np.full(len(keys), number)
    for at in range(0, len(keys), BATCH_ROWS):
        cut = slice(at, at + BATCH_ROWS)
        yield pa.RecordBatch.from_arrays([pa.array(keys[cut].view(np.int64)), pa.array(block[cut]), pa.array(counts[cut])], schema=GRAMS)


def grams_of(blocks: DataFrame, order: int, least: int = 1) -> DataFrame:
    """gram, block, n: the distinct n-grams of each block, from least words up to order. A block cut by the reader has a row of an n-gram for each piece."""

    def rows(number: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = gram_counts(block_of(pa.Table.from_batches(held).column("_hashes")), order, least)
        yield from _gram_rows(keys, number, counts)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = None, []
        for batch in batches:
            blocks_ = batch.column("_block").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(blocks_)) + 1).tolist(), len(blocks_)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                if low == high:
                    continue
                if held and number != int(blocks_[low]):
                    yield from rows(number, held)
                    held = []
                number = int(blocks_[low])
                held.append(batch.slice(low, high - low))
        if held:
            yield from rows(number, held)

    return blocks.select("_block", "_hashes").mapInArrow(explode, "gram long not null, block long, n long not null")


def longer_grams(blocks: DataFrame, told: DataFrame, n: int) -> DataFrame:
    """gram, block, n: the distinct n-grams of each block whose first and last n - 1 words told has for the block; others are in no second block."""

    def use(rows: pa.Table, told_: pa.Table) -> pa.Table:
        block, known = block_of(rows.column("_hashes")), np.sort(told_.column("gram").to_numpy().view(np.uint64))
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(known) and len(block.hashes):
            shorter = gram_keys(block.hashes, n - 1)
            held = known[np.minimum(np.searchsorted(known, shorter), len(known) - 1)] == shorter
            at = _positions(block, n)
            keys, counts = np.unique(gram_keys(block.hashes, n)[at[held[at] & held[at + 1]]], return_counts=True)
        number = rows.column("_block")[0].as_py() if rows.num_rows else 0
        return pa.Table.from_batches(list(_gram_rows(keys, number, counts.astype(np.int64))), schema=GRAMS)

    return blocks.select("_block", "_hashes").groupBy("_block").cogroup(told.select("block", "gram").groupBy("block")).applyInArrow(use, "gram long, block long, n long")


def told_back(grams: DataFrame) -> DataFrame:
    """block, gram, total: the count in the whole corpus of each n-gram that has more than one row of grams.

    Both sides of the join ask for all three columns (and are tested for null before), so Spark reuses one exchange and reads or explodes the n-grams once. No n-gram has
    more rows than there are blocks, so none is hot.
    """
    grams = grams.where("gram is not null and n is not null").repartition("gram")
    counts = grams.groupBy("gram").agg(F.sum("n").alias("total"), F.count("block").alias("owners")).where("owners > 1")
    return grams.join(counts.hint("merge"), "gram").where("total > n").select("block", "gram", "total")


def told_of_all(blocks: DataFrame, order: int, slices: int) -> DataFrame:
    """block, gram, total of every order, one order after the other, stored. Those of more than two words are joined in slices of their hashes."""
    found = [stored(told_back(grams_of(blocks, n, n)), "told") for n in range(1, min(order, 2) + 1)]
    last = found[-1]
    for n in range(3, order + 1):
        grams = stored(longer_grams(blocks, last, n), "grams")
        parts = [stored(told_back(in_slice(grams, "gram", i, slices)), "told") for i in range(slices)]
        last = reduce(DataFrame.unionAll, parts)
        found += parts
    return reduce(DataFrame.unionAll, found)


def in_slice(df: DataFrame, name: str, i: int, slices: int) -> DataFrame:
    return df.where(F.pmod(name, F.lit(slices)) == i) if slices > 1 else df


def _others(block: Block, n: int, keys: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Count of the n-gram at each word in all other documents; 0 where it would reach over the document's end. keys, ascending: those told, with their totals."""
    at = _positions(block, n)
    out = np.zeros(len(block.hashes), np.int64)
    if len(at):
        grams = gram_keys(block.hashes, n)[at]
        by = np.argsort(grams, kind="stable")  # the places of an n-gram ascend, and so do their documents
        grams, at = grams[by], at[by]
        doc = np.repeat(np.arange(len(block.bounds) - 1), np.diff(block.bounds))[at]
        new = np.concatenate([[True], grams[1:] != grams[:-1]])
        first = np.flatnonzero(new)
        total = np.diff(np.append(first, len(at)))
        if len(keys):
            place = np.minimum(np.searchsorted(keys, grams[first]), len(keys) - 1)
            total = np.where(keys[place] == grams[first], totals[place], total)
        own_first = np.flatnonzero(new | np.concatenate([[True], doc[1:] != doc[:-1]]))
        own = np.diff(np.append(own_first, len(at)))
        out[at] = np.repeat(total, np.diff(np.append(first, len(at)))) - np.repeat(own, own)
    return out


def scoring(order: int, backoff: float, all_words: int, kept: list[str]):
    def use(rows: pa.Table, told: pa.Table) -> pa.Table:
        block = block_of(rows.column("_hashes"))
        bounds, size = block.bounds, np.diff(block.bounds)
        n = len(block.hashes)
        log = np.zeros(n)
        if n:
            keys, totals = told.column("gram").to_numpy().view(np.uint64), told.column("total").to_numpy()
            by = np.argsort(keys)
            keys, totals = keys[by], totals[by]
            others = [_others(block, k, keys, totals) for k in range(1, order + 1)]
            doc = np.repeat(np.arange(len(size)), size)
            place = np.arange(n) - bounds[doc]
            rest = all_words - size[doc]
            log = np.log(np.maximum(others[0], 1) / np.where(others[0] > 0, np.maximum(rest, 1), rest + 1))
            level = np.ones(n, np.int64)
            for k in range(2, order + 1):
                able = place >= k - 1
                first = np.maximum(np.arange(n) - (k - 1), 0)
                whole, context = others[k - 1][first], others[k - 2][first]
                hit = able & (whole > 0)
                log = np.where(hit, np.log(np.maximum(whole, 1) / np.maximum(context, 1)), log + np.where(able, np.log(backoff), 0.0))
                level = np.where(hit, k, level)
            backed = level < np.minimum(place + 1, order)
        else:
            backed = np.zeros(0, bool)
        sums = per_text(log, bounds)
        mean = np.where(size > 0, sums / np.maximum(size, 1), np.nan)
        none = size == 0
        columns = [pa.array(size.astype(np.int64)), pa.array(sums), pa.array(mean, mask=none), pa.array(np.exp(-mean), mask=none), pa.array(per_text(backed, bounds).astype(np.int64))]
        names = [x.split()[0] for x in SCORES.split(", ")]
        return pa.Table.from_arrays([*(rows.column(name) for name in kept), *map(pa.chunked_array, zip(columns))], names=[*kept, *names])

    return use


def scored(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, block_bytes: int = BLOCK_BYTES, slices: int | None = None) -> DataFrame:
    """Every row of docs, its text replaced by the columns of SCORES.

    The n-gram at the front of a document, shorter than the order, is as long as it can be. log_score is the sum of natural
    logarithms over the words, mean_log_score its mean, perplexity exp(-mean); the last two are null for a text without words
    (null, empty). Repeated rows count as documents of their own, so a copy is well known. An empty table gives an empty result.
    A text longer than block_bytes is a block of its own, read whole by one task with about 150 bytes of memory a word (2 GB for 100 MB of text).
    The jobs run when this is called; the result is stored. A corpus of LARGE_WORDS is exchanged in slices, so that the disk holds a part at a time.
    """
    added = [x.split()[0] for x in SCORES.split(", ")]
    docs = docs.select("text", *(name for name in docs.columns if name not in ("text", *added)))
    kept = [name for name in docs.columns if name != "text"]
    plain = docs.select("text", *(F.col(f"`{name}`").alias(f"kept_{i}") for i, name in enumerate(kept)))
    conf = docs.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        blocks = in_blocks(plain, block_bytes)
        all_words = blocks.agg(F.sum("_words")).first()[0] or 0
        slices = slices or (SLICES if all_words >= LARGE_WORDS else 1)
        told = told_of_all(blocks, order, slices)
        inner = [name for name in plain.columns if name != "text"]
        schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema if f.name != "text"), SCORES])
        use, parts = scoring(order, backoff, all_words, inner), []
        for i in range(slices):
            mine = in_slice(blocks.select("_block", "_hashes", *inner), "_block", i, slices).groupBy("_block")
            parts.append(stored(mine.cogroup(in_slice(told, "block", i, slices).groupBy("block")).applyInArrow(use, schema), "scores"))
    finally:
        conf.set(CLEANUP, before)
    scores = reduce(DataFrame.unionAll, parts)
    return scores.select(*(F.col(x).alias(name) for x, name in zip(inner, kept, strict=True)), *added)


def scored_documents(docs: DataFrame) -> DataFrame:
    """doc_id and the columns of SCORES of every document."""
    return scored(docs.select("doc_id", "text"))
