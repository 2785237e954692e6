"""Relational merges: dimension upsert, insert-if-absent facts, key lookup, enrichment.

No join carries a broadcast hint: Spark broadcasts a side below its size threshold and shuffles
otherwise, where adaptive execution splits a hot key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galecast.operators.ordering import pick_one

CITY_ATTRIBUTES = ("latitude", "longitude", "region")


def enrich(df: DataFrame, reference: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a reference that holds one row per key, so rows do not multiply."""
    return df.join(reference, list(on), "left")


def unmatched_keys(enriched: DataFrame, key: str, attribute: str) -> DataFrame:
    """Distinct keys whose attribute is missing after the join (no match, or matched a NULL)."""
    return enriched.where(F.col(attribute).isNull()).select(key).distinct()


def upsert_cities(
    existing: DataFrame,
    incoming: DataFrame,
    number: Callable[[DataFrame], DataFrame],
    key: str = "city",
    attributes: Sequence[str] = CITY_ATTRIBUTES,
    version: str | None = None,
    last_id: int | None = None,
) -> DataFrame:
    """The dimension after ``incoming`` (one row per key): id, key, attributes (and version).

    A known key keeps its id and takes every incoming attribute, NULL included; with a ``version``
    column, only if the incoming version is not older. New keys get ids after the largest known one (or after
    ``last_id``, where ``existing`` is a part), in the order in which ``number`` positions them (it adds a 0-based ``position``).
    """
    columns = [*attributes, *([version] if version else [])]
    new = incoming.join(existing.select(key), key, "left_anti")
    sent = incoming.select(key, F.struct(*columns).alias("_new"))
    newer = F.col("_new").isNotNull()
    if version:
        newer &= F.coalesce(F.col(f"_new.{version}") >= F.col(version), F.lit(True))
    kept = existing.join(sent, key, "left").select(
        "id", key, *(F.when(newer, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in columns)
    )
    after = existing.agg(F.coalesce(F.max("id"), F.lit(0).cast("bigint"))).scalar() if last_id is None else F.lit(last_id)
    added = number(new).select(
        (after + F.col("position") + 1).cast("bigint").alias("id"), key, *columns
    )
    return kept.unionByName(added)


def changing(existing: DataFrame, incoming: DataFrame, key: str, attributes: Sequence[str], version: str) -> DataFrame:
    """The incoming rows that an upsert does not leave without effect: new keys, newer versions, and other attributes of the same."""
    columns = [*attributes, version]
    known = existing.select(key, F.struct(*columns).alias("_old"))
    older = F.col(f"_old.{version}") > F.col(version)
    same = F.struct(*columns).eqNullSafe(F.col("_old"))
    return incoming.join(known, key, "left").where(F.col("_old").isNull() | ~(F.coalesce(older, F.lit(False)) | same)).drop("_old")


def absent_facts(
    batch: DataFrame, stored: DataFrame, keys: Sequence[str], ordinal: Sequence[str]
) -> DataFrame:
    """The batch rows whose key is not stored yet; inside the batch the first row of a key wins.

    Both steps need the same partitioning, so the batch is shuffled once.
    """
    first = pick_one(batch, keys, [F.col(c).asc_nulls_first() for c in ordinal])
    return first.join(stored.select(*keys), list(keys), "left_anti")


def attach_ids(df: DataFrame, cities: DataFrame, key: str = "city", how: str = "left") -> DataFrame:
    """Adds ``ville_id`` by natural key."""
    ids = cities.select(F.col(key), F.col("id").alias("ville_id"))
    return df.join(ids, key, how)


def orphans(fact: DataFrame, fact_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Keys without a parent row, with their row count; both sides are reduced to one row a key first."""
    counted = (
        fact.where(F.col(fact_key).isNotNull())
        .groupBy(F.col(fact_key).alias("key"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return counted.join(parent.select(F.col(parent_key).alias("key")).distinct(), "key", "left_anti")
