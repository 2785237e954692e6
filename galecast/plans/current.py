"""A stored table that holds one row a key, the latest version, and is kept current load by load.

It lies by day and load. A load merges its rows with the stored rows of the days it touches and writes those days anew beside the old ones; which
load's folder of a day counts is told by the caller, who records it last. So no reader sees a half-written day, no other day is read or
written, and an older version that arrives late does not win.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galecast.operators.ordering import latest_versions
from galecast.sources.files import holds, read_folders

#: Files that a load writes for a day at most, so that one day does not land in one task.
FILES_PER_DAY = 16


def folders(path: str, day: str, loads: Iterable[tuple[date, int]]) -> list[str]:
    """Where the days of some loads lie."""
    return [f"{path}/{day}={when}/load={load}" for when, load in sorted(loads)]


def read_days(spark: SparkSession, path: str, schema: str, day: str, loads: Iterable[tuple[date, int]]) -> DataFrame:
    """The rows of some days as some loads left them; a filter on the day opens its folders only."""
    return read_folders(spark, path, f"{schema}, load int", folders(path, day, loads)).drop("load")


def write_days(rows: DataFrame, path: str, day: str, key: str, load: int) -> None:
    """Rows under their day and load, by key. Every attempt of a load has a number of its own, so nothing lies there yet."""
    spread = rows.withColumn("load", F.lit(load)).repartition(day, F.pmod(F.hash(key), F.lit(FILES_PER_DAY))).sortWithinPartitions(day, key)
    spread.write.mode("append").partitionBy(day, "load").parquet(path)


def written_days(spark: SparkSession, path: str, day: str, days: Iterable[date], load: int) -> list[date]:
    """Those of the days that a load wrote."""
    return [when for when in sorted(days) if holds(spark, f"{path}/{day}={when}/load={load}")]


def merge_latest(
    spark: SparkSession, path: str, schema: str, rows: DataFrame, known: Mapping[date, int], load: int,
    keys: Sequence[str] = ("ville_id", "date_prevision"), version: Sequence[str] = ("retrieved_at",),
) -> dict[date, int]:
    """Merges rows into the days they touch; the load that holds each day afterwards.

    ``known`` is the same before the load. The second key is the day; rows without one are not kept. The days of a load are few and
    go through the driver.
    """
    key, day = keys
    days = sorted(row[0] for row in rows.where(F.col(day).isNotNull()).select(day).distinct().collect())
    columns = [column.split(" ")[0] for column in schema.split(", ")]
    stored = read_days(spark, path, schema, day, [(when, known[when]) for when in days if when in known])
    both = rows.where(F.col(day).isNotNull()).select(*columns).unionByName(stored.select(*columns))
    write_days(latest_versions(both, keys, version), path, day, key, load)
    return {**known, **dict.fromkeys(days, load)}
