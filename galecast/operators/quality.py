"""Quality reports. Each is one pass whose shuffle carries partial aggregates only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.operators.ordering import keep_first_counted


def _as_rows(totals: DataFrame, label: str = "metric", value: str = "n_rows") -> DataFrame:
    return totals.unpivot([], list(totals.columns), label, value)


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once. Empty means the key is unique."""
    return key_counts(df, keys).where(F.col("n_rows") > 1)


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, keys occurring more than once, rows beyond the first of their key."""
    return key_counts(df, keys).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("n_rows") > 1).alias("n_duplicated_keys"),
        F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).cast("bigint").alias("n_surplus_rows"),
    )


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: how many values are missing."""
    totals = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return _as_rows(totals, "column_name", "n_missing")


def overlong_counts(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """One row per text column: values longer than the column may hold."""
    totals = df.agg(*(F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()))
    return _as_rows(totals, "column_name", "n_too_long")


def coverage_report(
    df: DataFrame, city: str, required: Sequence[str], expected: DataFrame, expected_city: str
) -> DataFrame:
    """Rows, cities present against cities expected, and missing values per required column.

    Cities are grouped first, so the distinct count is a plain count of groups.
    """
    per_city = df.groupBy(city).agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in required),
    )
    per_name = expected.groupBy(expected_city).agg(F.count(F.lit(1)).alias("_rows"))
    wanted = per_name.agg(
        F.struct(
            F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("rows"),
            F.count(expected_city).alias("names"),
        ).alias("wanted")
    ).scalar()
    totals = per_city.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(city).alias("cities_present"),
        *(
            F.coalesce(F.sum(f"missing_{c}"), F.lit(0)).cast("bigint").alias(f"missing_{c}")
            for c in required
        ),
    )
    totals = totals.withColumn("_wanted", wanted).select(
        "rows",
        "cities_present",
        F.col("_wanted.rows").alias("cities_expected"),
        F.col("_wanted.names").alias("cities_expected_distinct"),
        *(f"missing_{c}" for c in required),
    )
    return _as_rows(totals)


def stage_totals(first: DataFrame) -> DataFrame:
    """One row: rows before and after keep-first, accepted and rejected, from kept rows with their ``copies`` and verdict."""
    return first.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("flattened"),
        F.count(F.lit(1)).alias("deduplicated"),
        F.count_if("accepted").alias("accepted"),
        F.count_if(~F.col("accepted")).alias("rejected"),
    )


def stage_counts(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str], accepted: Column) -> DataFrame:
    """The same as rows, from rows that are not reduced yet."""
    slim = df.select(*keys, *ordinal, accepted.alias("accepted"))
    return _as_rows(stage_totals(keep_first_counted(slim, keys, ordinal)), "stage", "n_rows")
