"""Keep-first, latest-version and global-position operators.

The one-row-per-key operators are a ``row_number() = 1`` filter: Spark plans it with a group limit
below the shuffle, so a hot key sends one row per map task, never all of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order; missing keys form a key of their own."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """Drop all but the first row of every key in source order."""
    return pick_one(df, keys, [F.col(c).asc_nulls_first() for c in ordinal])


def keep_first_counted(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str], count: str = "copies") -> DataFrame:
    """The first row of every key in source order, with the number of rows of its key.

    One aggregate, which reduces a hot key below the shuffle. As the number stays with the row, duplicates are a sum over rows
    that were written, whatever was computed twice on the way.
    """
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*ordinal)).alias("_first"), F.count(F.lit(1)).alias(count))
    return first.select(*keys, "_first.*", count)


def latest_versions(
    df: DataFrame,
    keys: Sequence[str] = ("ville_id", "date_prevision"),
    version: Sequence[str] = ("retrieved_at",),
) -> DataFrame:
    """The most recent version of every key."""
    return pick_one(df, keys, [F.col(c).desc() for c in version])


def latest_run_rows(df: DataFrame, run: str = "run_ts") -> DataFrame:
    """The rows of the latest run; its name is one aggregate, so no rows are moved."""
    return df.where(F.col(run) == df.agg(F.max(run)).scalar())


def worst_day(
    df: DataFrame,
    key: str = "ville_id",
    score: str = "risk_score",
    day: str = "date_prevision",
) -> DataFrame:
    """The row with the highest score of every key; the earlier day wins a tie."""
    return pick_one(df, [key], [F.col(score).desc_nulls_last(), F.col(day).asc()])


def _rows_before(df: DataFrame, group: Sequence[str], digit: str) -> DataFrame:
    """One row per group and digit with ``_size`` and ``_before``, the rows of its smaller digits."""
    window = Window.partitionBy(*group).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(*group, digit).agg(F.sum("_size").alias("_size"))
    return sizes.withColumn("_before", F.coalesce(F.sum("_size").over(window), F.lit(0).cast("bigint")))


def key_position(df: DataFrame, key: str, name: str = "position", bits: int = 16) -> DataFrame:
    """0-based position in the order of a unique, non-negative 64-bit integer key.

    A running count over the whole table would be one task. Instead the key is read as digits of
    ``bits`` bits. Rows are counted by prefix, from the longest to the shortest; on each level a
    prefix adds the rows of its smaller siblings. As the key is unique, no window group holds more
    than ``2 ** bits`` rows, however the keys are spread. A missing key is an error.
    """
    if not 2 <= bits <= 31:
        raise ValueError("a digit has 2 to 31 bits")
    present = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"a row without {key} has no position"))).otherwise(F.col(key))
    df = df.withColumn("_key", present.cast("bigint"))
    shifts = range(bits, 63, bits)
    inside = F.row_number().over(Window.partitionBy("_p0").orderBy("_key")) - 1
    counts = df.groupBy(F.shiftright("_key", bits).alias("_p0")).agg(F.count(F.lit(1)).alias("_size"))
    starts = counts.select("_p0", "_size", F.lit(0).cast("bigint").alias("_start"))
    sizes = counts
    for level, _ in enumerate(shifts):
        here, above = f"_p{level}", f"_p{level + 1}"
        sizes = sizes.select(here, F.shiftright(here, bits).alias(above), "_size")
        before = _rows_before(sizes, [above], here).select(here, "_before")
        starts = starts.join(before, here).withColumn("_start", F.col("_start") + F.col("_before")).drop("_before")
        starts = starts.withColumn(above, F.shiftright(here, bits))
        sizes = sizes.groupBy(above).agg(F.sum("_size").alias("_size"))
    numbered = df.withColumn("_p0", F.shiftright("_key", bits)).withColumn("_inside", inside)
    numbered = numbered.join(starts.select("_p0", "_start"), "_p0")
    return numbered.withColumn(name, F.col("_start") + F.col("_inside")).select(*[c for c in df.columns if c != "_key"], name)


def split_position(df: DataFrame, split: str, row: str, name: str = "position") -> DataFrame:
    """0-based position in the order (split, row), for rows that know their input split.

    Rows are numbered inside pieces of a split, cut by the row number's upper bits, so that a split
    of any size, a whole file for instance, spreads over many tasks. What comes before a piece is
    summed in two levels: within its split, and over the splits, one row each.
    """
    piece = F.shiftright(F.col(row), 16)
    inside = F.row_number().over(Window.partitionBy(split, "_piece").orderBy(row)) - 1
    sizes = df.groupBy(split, piece.alias("_piece")).agg(F.count(F.lit(1)).alias("_size"))
    pieces = _rows_before(sizes, [split], "_piece").withColumnRenamed("_before", "_inner").drop("_size")
    totals = sizes.groupBy(split).agg(F.sum("_size").alias("_size"))
    files = totals.withColumn("_file", F.substring_index(split, "#", 1))
    within = _rows_before(files, ["_file"], split).withColumnRenamed("_before", "_outer").drop("_size")
    first = _rows_before(files.select("_file", "_size"), [], "_file").select("_file", "_before")
    starts = pieces.join(within.join(first, "_file"), split)
    starts = starts.select(split, "_piece", (F.col("_inner") + F.col("_outer") + F.col("_before")).alias("_start"))
    numbered = df.withColumn("_piece", piece).withColumn("_inside", inside).join(starts, [split, "_piece"])
    return numbered.withColumn(name, F.col("_start") + F.col("_inside")).select(*df.columns, name)


def require_no_rows(df: DataFrame, message: str) -> None:
    """Raise if the relation holds any row."""
    if not df.isEmpty():
        raise ValueError(message)


def require_rows(df: DataFrame, message: str) -> None:
    """Raise if the relation is empty."""
    if df.isEmpty():
        raise ValueError(message)
