"""SimHash near-duplicates found by deletion-variant signatures.

A fingerprint is cut into fewer segments than bits may differ, as few as leave one of them with one differing bit at most (4 bits:
3 segments). For each segment, each of its bits is wildcarded in turn; fingerprints that share a wildcarded segment are
candidates, joined by equality on (bit, rest of the segment) and verified by their Hamming distance. Only distinct fingerprints
are indexed, so copies cost nothing, and a bucket of equal signatures yields a spanning forest of its links, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galecast.llm.shared import stored
from galecast.llm.text import passes, texts, words

SHINGLE, DISTANCE, SEED = 4, 4, 42
BITS = 64
#: Signature rows that meet in one task on average.
BUCKET_ROWS = 1 << 18
#: Shingles that are hashed and counted together; bounds the memory of a very long text.
BLOCK = 1 << 18
#: Up to this size, a run of equal signatures is compared by shifting it along itself, all runs at once.
SHORT_RUN = 16
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def segments(distance: int, bits: int = BITS) -> list[tuple[int, int]]:
    """(first bit, bits): with s segments one has distance // s differing bits at most, so s = distance // 2 + 1 leaves one or none."""
    number = distance // 2 + 1
    edges = [bits * i // number for i in range(number + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def fingerprints_of(column: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text: a bit is set if it is set in over half of the hashes of its shingles."""
    data, offsets = texts(column)
    raw = data.tobytes().translate(_LOWER)
    joined = [b" ".join(raw[a:b].split()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    sizes = np.cumsum([0] + [len(x) for x in joined])
    buffer = b"".join(joined)
    starts, ends, bounds = words(np.frombuffer(buffer, np.uint8), sizes)
    n_words = np.diff(bounds)
    counts = np.where(n_words == 0, 0, np.maximum(n_words - shingle + 1, 1))
    firsts = np.repeat(bounds[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    lasts = firsts + np.repeat(np.minimum(n_words, shingle), counts) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.empty(len(firsts), "<u8")
    for i in range(0, len(firsts), BLOCK):
        spans = zip(starts[firsts[i : i + BLOCK]].tolist(), ends[lasts[i : i + BLOCK]].tolist(), strict=True)
        hashes[i : i + BLOCK] = np.fromiter((digest(buffer[a:b], SEED) for a, b in spans), np.uint64)
    out = np.zeros(len(counts), np.uint64)
    at = np.concatenate([[0], np.cumsum(counts)])
    for i in np.flatnonzero(counts):
        out[i] = np.packbits(2 * ones(hashes[at[i] : at[i + 1]]) > counts[i], bitorder="little").view("<u8")[0]
    return out


def ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    total = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), BLOCK):
        part = hashes[i : i + BLOCK].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Every row of docs (no text, extra columns allowed) with its fingerprint `fp`, a signed long; the text is left out."""
    kept = [name for name in docs.columns if name not in ("text", "fp")]

    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch):
                fp = fingerprints_of(part.column("text"), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(name) for name in kept), pa.array(fp)], names=[*kept, "fp"])

    schema = docs.select(kept).schema.add("fp", "long")
    return docs.select(*kept, "text").mapInArrow(hash_, schema)


def find(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (least index reachable) after joining a[i] with b[i]."""
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        for side in (a, b):
            np.minimum.at(label, before[side], low)
            np.minimum.at(label, side, low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        if (label == before).all():
            return label


def forest(key: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one bucket: (fingerprint, root) for every fingerprint that some equal signature links to another."""
    order = np.lexsort((fp, key))
    key, fp = key[order], fp[order]
    values, node = np.unique(fp, return_inverse=True)
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, int)
    size = np.diff(edge)
    left, right = [], []
    short = np.repeat(size <= SHORT_RUN, size)
    for lag in range(1, SHORT_RUN):
        i = np.flatnonzero((key[lag:] == key[:-lag]) & short[lag:])
        i = i[np.bitwise_count(fp[i] ^ fp[i + lag]) <= distance]
        left.append(node[i])
        right.append(node[i + lag])
    for run in np.flatnonzero(size > SHORT_RUN):
        members, numbers = fp[edge[run] : edge[run + 1]], node[edge[run] : edge[run + 1]]
        open_ = np.arange(len(members))
        while len(open_):
            wave, open_ = [open_[0]], open_[1:]
            while wave and len(open_):
                at = wave.pop()
                near = np.bitwise_count(members[open_] ^ members[at]) <= distance
                hit, open_ = open_[near], open_[~near]
                left.append(np.full(len(hit), numbers[at]))
                right.append(numbers[hit])
                wave.extend(hit.tolist())
    left, right = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (left, right))
    label = find(np.arange(len(values)), left, right)
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def links(fps: DataFrame, distance: int = DISTANCE, bits: int = BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """fp, root: links that connect all distinct fingerprints of fps whose bits differ in `distance` places or fewer.

    The rows connect what all links would connect; each is verified or joins through verified links of its bucket.
    """
    cuts = segments(distance, bits)
    buckets = max(1, -(-fps.count() * bits // bucket_rows))

    def variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for begin in range(0, len(fp), 1 << 15):
                some = fp[begin : begin + (1 << 15)]
                at = [(bit, first, size) for first, size in cuts for bit in range(first, first + size)]
                key = np.concatenate([signature(some, bit, first, size) for bit, first, size in at])
                place = key * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
                bucket = (place % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
                whole = np.tile(some, len(at))
                for k in np.flatnonzero(np.diff(edge)):
                    i = order[edge[k] : edge[k + 1]]
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array([int(k)]), "key": [key[i].tobytes()], "fps": [whole[i].tobytes()]})

    def join(table: pa.Table) -> pa.Table:
        key, fp = (np.frombuffer(b"".join(table.column(name).to_pylist()), np.uint64) for name in ("key", "fps"))
        a, b = forest(key, fp, distance)
        return pa.table({"fp": a.view(np.int64), "root": b.view(np.int64)})

    packed = fps.select("fp").mapInArrow(variants, "bucket long, key binary, fps binary")
    return packed.groupBy("bucket").applyInArrow(join, "fp long, root long")


def signature(fp: np.ndarray, bit: int, first: int, size: int) -> np.ndarray:
    """The segment with one bit wildcarded, and which bit that is."""
    rest = (fp >> np.uint64(first)) & np.uint64((1 << size) - 1) & ~np.uint64(1 << (bit - first))
    return rest | np.uint64(bit << 40)


def components(edges: DataFrame) -> DataFrame:
    """node, root (least node reachable) of every node in edges (a, b), by alternating large and small stars.

    A step is an aggregate and a join, so a node with very many links is pre-aggregated and split; each round is written to
    the shared folder, and the rounds end when one changes nothing.
    """
    both = lambda e: e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    def star(e: DataFrame) -> DataFrame:
        least = e.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        return e.join(least, "u")

    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = mark(edges)
    while True:
        large = star(both(edges)).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        small = star(large.select(F.col("a").alias("u"), F.col("b").alias("v")))
        small = small.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = stored(small.where("a <> b").distinct(), "edges")
        now = mark(edges)
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now


def classes(hashed: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """fp, class: the class (least fingerprint, as a signed long, reachable) of every distinct fingerprint in a stored table."""
    nodes = hashed.select("fp").distinct()
    found = links(nodes, distance)
    roots = components(found.select(F.col("fp").alias("a"), F.col("root").alias("b")))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("class"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (least doc_id reachable) of every row of docs.

    A null text, an empty one and one without words have fingerprint zero and are linked like any other. Equal rows each get their
    row. A class whose doc_ids are all null has a null component_id. An empty table gives an empty result.
    """
    hashed = stored(with_fingerprints(docs.select("doc_id", "text"), shingle), "fingerprints")
    first = hashed.groupBy("fp").agg(F.min("doc_id").alias("first"))
    known = classes(hashed, distance).join(first, "fp")
    least = known.groupBy("class").agg(F.min("first").alias("component_id"))
    named = known.join(least, "class").select("fp", "component_id")
    return hashed.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of docs that stay, one of each class, with the columns of docs: that with the least doc_id (a null one last),
    then the least hash of its text; of rows equal in both, any one."""
    keys = [F.xxhash64("doc_id", F.lit(0)).alias("_a"), F.xxhash64("text").alias("_b")]
    hashed = stored(with_fingerprints(docs.select("doc_id", "text", *keys), shingle), "fingerprints")
    best = hashed.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_b", "_a")).alias("best"))
    kept = classes(hashed, distance).join(best, "fp").groupBy("class").agg(F.min("best").alias("best")).select("best._a", "best._b")
    rows = docs.select(F.struct("*").alias("_all"), *keys).join(kept, ["_a", "_b"])
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy("_a", "_b").orderBy(F.lit(0)))).where("_n = 1").select("_all.*")
