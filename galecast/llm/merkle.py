"""A Merkle manifest of a table: a tree of hashes for each group of rows, and a tree over their roots.

Of all levels only every EVERY-th is stored. An aligned subtree of up to 2 ** EVERY stored nodes has one stored node above it; a
task that holds such a subtree regenerates the levels between for as long as it needs them: to find the node above when the tree is
built, to emit the siblings of its nodes when proofs are extracted. Subtrees are the groups of the shuffle, so no task holds more than
2 ** EVERY nodes, whatever share of the rows one group has. A node is the SHA-256 of its children's digests as lowercase hex, one after
the other; the last node of a level may have one child.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from galecast.llm.shared import stored

#: Levels from one stored level to the next.
EVERY = 10
#: Fixed value: what a leaf is made of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST_BYTES = 32
_NODE = "tree string, pos long, size long, digest binary"


class Manifest(NamedTuple):
    """Stored levels of the groups' trees (the first holds the leaves and what is carried with them) and of the tree over their roots."""

    groups: list[DataFrame]
    top: list[DataFrame]
    every: int


def leaf(values: dict[str, Column]) -> Column:
    """The digest of a row: each value's UTF-8 byte count, a colon and the value, or a dash where it is missing."""
    texts = (value.cast("string") for value in values.values())
    return F.unhex(F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts)), 256))


def parent(children: bytes) -> bytes:
    return sha256(children.hex().encode()).digest()


def levels(nodes: list[bytes], steps: int) -> list[list[bytes]]:
    """Nodes of a subtree and the levels above them."""
    out = [nodes]
    for _ in range(steps):
        below = out[-1]
        out.append([parent(b"".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return out


def height(size: int) -> int:
    """Levels above the leaves of a tree."""
    return max(size - 1, 0).bit_length()


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows (tree, order …) with pos, the place in their tree, and size, the rows of the tree.

    Rows are dealt by ranges of (tree, order), so a large tree spreads over many tasks; one row for each tree and range tells what
    lies before it.
    """
    keys = ["tree", *order]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = stored(ordered.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "leaves")
    runs = numbered.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        "tree", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(Window.partitionBy("tree")).alias("size")
    )
    rest = [name for name in numbered.columns if name not in ("tree", "part", "row")]
    return numbered.join(starts, ["tree", "part"]).select("tree", (F.col("row") + F.col("shift")).alias("pos"), "size", *rest)


def _steps(size: int, base: int, every: int) -> int:
    return min(every, max(height(size) - base, 0))


def grown(leaves: DataFrame, every: int) -> list[DataFrame]:
    """The stored levels over leaves (tree, pos, size, digest); the last holds one node for each tree."""
    leaves = stored(leaves, "merkle")
    out, tallest = [leaves], height(leaves.agg(F.max("size")).first()[0] or 0)
    for base in range(0, max(tallest, 1), every):
        nodes = out[-1].select("tree", "pos", "size", "digest", F.shiftright("pos", every).alias("block"))
        out.append(stored(nodes.groupBy("tree", "block").applyInArrow(_above(base, every), _NODE), "merkle"))
    return out


def _above(base: int, every: int) -> Callable[[pa.Table], pa.Table]:
    """The stored node above a subtree whose lowest level is `base`."""

    def above(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        size = table.column("size")[0].as_py()
        (node,) = levels(table.column("digest").to_pylist(), _steps(size, base, every))[-1]
        return pa.table({"tree": table.column("tree")[:1], "pos": [table.column("block")[0].as_py()], "size": [size], "digest": pa.array([node], pa.binary())})

    return above


def extracted(tree_levels: list[DataFrame], above: DataFrame, every: int) -> DataFrame:
    """The rows of the lowest level, each with the siblings on its way up (path) and the further columns of `above`.

    `above` has one row for each tree: tree, pos 0, path from there on, and further columns.
    """
    for i in reversed(range(len(tree_levels) - 1)):
        nodes = tree_levels[i]
        kept = [name for name in nodes.columns if name not in ("tree", "pos")]
        more = [name for name in above.columns if name not in ("tree", "pos", "path", *kept)]
        nodes = nodes.withColumn("block", F.shiftright("pos", every))
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.select("tree", "pos", *kept).schema)
        schema += ", path binary" + "".join(f", {name} {above.schema[name].dataType.simpleString()}" for name in more)
        upper = above.select("tree", F.col("pos").alias("block"), "path", *more)
        above = nodes.groupBy("tree", "block").cogroup(upper.groupBy("tree", "block")).applyInArrow(_siblings(i * every, every, kept, more), schema)
    return above


def _siblings(base: int, every: int, kept: Sequence[str], more: Sequence[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The paths of a subtree's lowest nodes, from its regenerated levels and the path of the node above it."""

    def siblings(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("pos")
        between = levels(left.column("digest").to_pylist(), _steps(left.column("size")[0].as_py(), base, every))
        paths = [right.column("path")[0].as_py()]
        for level in reversed(between[:-1]):
            paths = [(level[j ^ 1] if j ^ 1 < len(level) else b"") + paths[j >> 1] for j in range(len(level))]
        out = {name: left.column(name) for name in ("tree", "pos", *kept)} | {"path": pa.array(paths, pa.binary())}
        first = pa.array([0] * len(left), pa.int32())
        return pa.table(out | {name: right.column(name).combine_chunks().take(first) for name in more})

    return siblings


def manifest(docs: DataFrame, group: str = "lang", order: str = "doc_id", fields: Sequence[str] = FIELDS, carried: dict[str, Column] | None = None, every: int = EVERY) -> Manifest:
    """The manifest of docs: one tree a group, leaves by ascending order column.

    A missing group is a group of its own, before all others; a missing order value comes first, and rows with equal ones lie by their
    leaf's digest, so repeated rows lie side by side. Texts of any length are hashed where they are read. Columns beyond the fields
    do not count. An empty table has no trees and no root. `carried` names expressions over docs that stay with the leaves.
    """
    named = {name: F.col(f"`{name}`") for name in fields}
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("")).alias("tree")
    rows = docs.select(tree, F.col(f"`{order}`").alias("key"), leaf(named).alias("digest"), *(value.alias(name) for name, value in (carried or {}).items()))
    groups = grown(placed(stored(rows, "hashes").withColumn("tie", F.monotonically_increasing_id()), ["key", "digest", "tie"]).drop("tie"), every)
    roots = groups[-1].select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    return Manifest(groups, grown(placed(roots, ["group"]), every), every)


def proofs(made: Manifest) -> DataFrame:
    """One row a leaf: key and carried columns, digest, its place (pos of size in its group, top_pos of top_size among groups), subroot,
    root, and path, the siblings from the leaf to the root, 32 bytes each."""
    root = made.top[-1].select("tree", "pos", F.lit(b"").alias("path"), F.col("digest").alias("root"))
    tops = extracted(made.top, root, made.every)
    above = tops.select(
        F.col("group").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot"), "root", F.col("pos").alias("top_pos"), F.col("size").alias("top_size")
    )
    return extracted(made.groups, above, made.every).drop("tree")


def fold(digest: bytes, places: Sequence[tuple[int, int]], path: bytes) -> bytes:
    """The root that a digest leads to with a path of siblings; places: (pos, size) in its tree, then of the tree among the trees."""
    at = 0
    for pos, size in places:
        while size > 1:
            pair = digest
            if pos ^ 1 < size:
                beside = path[at : at + DIGEST_BYTES]
                at += DIGEST_BYTES
                pair = beside + digest if pos & 1 else digest + beside
            digest, pos, size = parent(pair), pos >> 1, (size + 1) >> 1
    return digest


def folded(rows: DataFrame, digest: str) -> DataFrame:
    """Rows of proofs with folded, the root that the digest of a column leads to. No shuffle."""
    schema = StructType([*rows.schema.fields, StructField("folded", BinaryType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in (digest, "pos", "size", "top_pos", "top_size", "path")]
            out = [fold(d, ((p, n), (q, m)), path) for d, p, n, q, m, path in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "folded"])

    return rows.mapInArrow(each, schema)


def verified_documents(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """Every document's leaf, proof and verdict; where 7 divides crc32(doc_id as text), the leaf is checked with n_chars one higher."""
    tampered = {name: F.col(name) for name in FIELDS} | {"n_chars": F.col("n_chars") + 1}
    changed = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    made = manifest(docs, carried={"tampered": F.when(changed, leaf(tampered))}, every=every)
    rows = folded(proofs(made).withColumn("shown", F.coalesce("tampered", "digest")), "shown")

    def text(name: str) -> Column:
        return F.lower(F.hex(name))

    return rows.select(
        F.col("key").alias("doc_id"),
        text("digest").alias("leaf"),
        text("subroot").alias("subroot"),
        text("root").alias("root"),
        F.sha2(text("path"), 256).alias("proof_sha256"),
        text("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
