"""The six analytics questions over the latest forecast versions.

Every per-city question groups by the city's id first and joins the name to one row per city, so
the join never moves forecast rows. Ties are broken by name or date, which also lets a sort on few
distinct scores spread over all tasks.
Fixed values: the names of the result columns, which users' reports refer to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.operators.ordering import latest_versions, worst_day

CITY, DAY, SCORE = "ville_id", "date_prevision", "risk_score"


def latest(fact: DataFrame, version: Sequence[str] = ("retrieved_at",)) -> DataFrame:
    return latest_versions(fact, (CITY, DAY), version)


def with_city_name(per_city: DataFrame, cities: DataFrame) -> DataFrame:
    names = cities.select(F.col("id").alias(CITY), "city")
    return per_city.join(names, CITY)


def top_by_city(current: DataFrame, cities: DataFrame, value: Column, name: str) -> DataFrame:
    per_city = current.groupBy(CITY).agg(value.alias(name))
    return (
        with_city_name(per_city, cities)
        .select("city", name)
        .orderBy(F.col(name).desc_nulls_first(), "city")
        .limit(10)
    )


def hottest_cities(current: DataFrame, cities: DataFrame) -> DataFrame:
    """Question 1: ten highest forecast temperatures."""
    return top_by_city(current, cities, F.max("temperature_max"), "temperature_max_observee")


def wettest_cities(current: DataFrame, cities: DataFrame) -> DataFrame:
    """Question 2: ten highest forecast precipitation sums."""
    return top_by_city(current, cities, F.max("precipitation_sum"), "precipitation_max_observee")


def riskiest_cities(current: DataFrame, cities: DataFrame) -> DataFrame:
    """Question 3: ten highest mean risks, rounded half away from zero."""
    return top_by_city(current, cities, F.round(F.avg(SCORE), 1), "risque_moyen")


def risk_by_day(current: DataFrame) -> DataFrame:
    """Question 4: mean and maximum risk per date."""
    per_day = current.groupBy(DAY).agg(
        F.round(F.avg(SCORE), 1).alias("risque_moyen_ce_jour"),
        F.max(SCORE).alias("risque_maximal_observe_ce_jour"),
    )
    return in_falling_order(per_day)


def in_falling_order(per_day: DataFrame) -> DataFrame:
    return per_day.orderBy(F.col("risque_moyen_ce_jour").desc_nulls_first(), DAY)


def worst_day_by_city(current: DataFrame, cities: DataFrame) -> DataFrame:
    """Question 5: each city's riskiest date, the earlier one on a tie."""
    return worst_in_order(worst_day(current, CITY, SCORE, DAY), cities)


def worst_in_order(worst: DataFrame, cities: DataFrame) -> DataFrame:
    return with_city_name(worst, cities).select(
        "city", F.col(DAY).alias("periode_la_plus_a_risque"), SCORE, "risk_level"
    ).orderBy(F.col(SCORE).desc_nulls_first(), "city")


def cities_above_average(current: DataFrame, cities: DataFrame) -> DataFrame:
    """Question 6: cities whose mean exceeds the mean over all rows.

    The comparison is exact, on cross-multiplied integers. The overall sums come from the per-city
    sums; as the id is never missing, saying so lets both uses share one grouping.
    """
    per_city = current.where(F.col(CITY).isNotNull()).groupBy(CITY).agg(
        F.sum(SCORE).alias("_sum"), F.count(SCORE).alias("_n")
    )
    return above_average(per_city, cities)


def above_average(per_city: DataFrame, cities: DataFrame) -> DataFrame:
    """From each city's sum ``_sum`` and number ``_n`` of scores."""
    overall = per_city.agg(F.struct(F.sum("_sum").alias("sum"), F.sum("_n").alias("n")).alias("_all"))
    wide = "decimal(19,0)"
    above = per_city.withColumn("_all", overall.scalar()).where(
        F.col("_sum").cast(wide) * F.col("_all.n").cast(wide)
        > F.col("_all.sum").cast(wide) * F.col("_n").cast(wide)
    )
    mean = F.round(F.try_divide(F.col("_sum").cast("double"), F.col("_n").cast("double")), 1)
    return (
        with_city_name(above, cities)
        .select("city", mean.alias("risque_moyen_ville"))
        .orderBy(F.col("risque_moyen_ville").desc_nulls_first(), "city")
    )


QUESTIONS = {
    "q1": hottest_cities,
    "q2": wettest_cities,
    "q3": riskiest_cities,
    "q4": lambda current, cities: risk_by_day(current),
    "q5": worst_day_by_city,
    "q6": cities_above_average,
}
