"""Sharding by proportional stratified interleaving: each shard holds the sources in the proportions of the whole.

The rows of a source are put in a seeded random order; row r of n gets the fractional rank (r - 1 + phase) / n, with a random
phase from 0 to 1 for each source, or sources of equal size would come in clumps. Sorted by that rank, every stretch of the table
holds each source in proportion, so cutting the sequence into equal counts makes every shard match
the mixture. Neither order needs a window over a whole source or table: a row's place is the number of rows in the buckets
before its own plus its place in its bucket. Buckets cut the (uniform) random order, or the ranks, into equal pieces.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one bucket holds on average.
BUCKET_ROWS = 4096
_SPAN = 1 << 40


def _places(df: DataFrame, group: list[str], order: list[str], place: str) -> DataFrame:
    """df with the 1-based place of a row in its group and `_of`, the rows of the group; needs a column _bucket that rises
    with the order. The windows over a whole group see one row for each bucket."""
    counts = df.groupBy(*group, "_bucket").agg(F.count("*").alias("_rows"))
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).withColumn("_of", F.sum("_rows").over(whole)).drop("_rows")
    keys = [*group, "_bucket"]
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_within", within).join(counts, keys).withColumn(place, F.col("_before") + F.col("_within")).drop("_before", "_within")


def shards(docs: DataFrame, number: int, source: Column, key: Column, tie: Column, seed: int = 7, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Every row of docs with `shard` (0 to number - 1) and `slot` (gapless from 0 in each shard); counts differ by one at most.

    key seeds the random order, tie breaks equal hashes; rows equal in both are interchangeable. A null source is a source of
    its own. Equal seeds give equal shards. An empty table gives an empty result. docs must not be random when computed again.
    Columns named shard, slot or with a leading underscore are replaced.
    """
    rows = docs.count()
    random = F.pmod(F.xxhash64(F.lit(seed), key, tie), F.lit(_SPAN))
    pieces = max(1, math.ceil(rows / bucket_rows))
    df = docs.withColumns({"_source": F.coalesce(F.concat(F.lit("s"), source), F.lit("n")), "_random": random, "_key": key, "_tie": tie})
    df = df.withColumn("_bucket", F.floor(F.col("_random") * F.lit(pieces) / F.lit(_SPAN)))
    df = _places(df, ["_source"], ["_random", "_key", "_tie"], "_rank")
    phase = F.pmod(F.xxhash64(F.lit(seed), "_source"), F.lit(_SPAN)) / F.lit(_SPAN)
    df = df.withColumn("_share", (F.col("_rank") - 1 + phase) / F.col("_of")).drop("_of")
    df = df.withColumn("_bucket", F.floor(F.col("_share") * F.lit(pieces)))
    df = _places(df, [], ["_share", "_source"], "_place")
    cut = F.expr(f"(_place - 1) * {number} div {max(rows, 1)}").cast("int")
    first = F.expr(f"(shard * {max(rows, 1)}L + {number - 1}) div {number}")
    df = df.withColumn("shard", cut).withColumn("slot", F.col("_place") - 1 - first)
    return df.drop("_source", "_random", "_key", "_tie", "_bucket", "_rank", "_of", "_share", "_place")


def sharded_documents(docs: DataFrame, number: int = 40, seed: int = 7) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document.

    The law is `rows`: shard counts differ by one at most. Size is the UTF-8 bytes of the text (none for a null) plus 16. The text
    itself is not shuffled, its size and checksum are.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select("doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = shards(slim, number, F.col("source"), F.col("doc_id"), F.struct("text_crc32", "size"), seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")
