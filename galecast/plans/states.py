"""Mergeable figures of the latest versions: per city, month and level, and per date and level.

A load forms the states of the months it touched anew from the latest versions of those months, as a version that was replaced can't be
taken out of a maximum. A selection merges the states of the months it covers whole and reads versions only for the days of months it cuts. Scores
are whole numbers, so their sums are exact and a mean of merged states equals the mean over the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galecast.model import HIGH, FilterSpec
from galecast.plans import analytics, serving
from galecast.plans.analytics import CITY, DAY, SCORE
from galecast.plans.current import read_days, write_days

MONTH, LEVEL = "mois", "risk_level"
_SUMS = "n bigint, n_scores bigint, risk_sum bigint, risk_max int"
DAY_STATES = f"{DAY} date, {MONTH} date, {LEVEL} string, {_SUMS}"


def city_schema(temperature: str = "decimal(5,2)", rain: str = "decimal(6,2)") -> str:
    """The columns of a city's states; both maxima keep the names and types that they have in the rows."""
    return f"{CITY} bigint, {MONTH} date, {LEVEL} string, {_SUMS}, temperature_max {temperature}, precipitation_sum {rain}, first_day date, worst_day date"


def months_of(days: Iterable[date]) -> set[date]:
    return {day.replace(day=1) for day in days}


def _formed(rows: DataFrame, key: str, *more: Column) -> DataFrame:
    month = F.trunc(DAY, "month").alias(MONTH)
    return rows.groupBy(key, month, LEVEL).agg(
        F.count(F.lit(1)).alias("n"), F.count(SCORE).alias("n_scores"), F.sum(SCORE).alias("risk_sum"), F.max(SCORE).alias("risk_max"), *more
    )


def city_states(rows: DataFrame) -> DataFrame:
    """The states of rows that hold one version of each city and date."""
    worst = F.struct(F.col(SCORE).isNull().alias("none"), (-F.col(SCORE)).alias("falling"), DAY)
    return _formed(
        rows, CITY, F.max("temperature_max").alias("temperature_max"), F.max("precipitation_sum").alias("precipitation_sum"),
        F.min(DAY).alias("first_day"), F.min_by(DAY, worst).alias("worst_day"),
    )


def day_states(rows: DataFrame) -> DataFrame:
    return _formed(rows, DAY)


def merge_states(path: str, rows: DataFrame, months: Iterable[date], known: Mapping[date, int], load: int) -> dict[date, int]:
    """Writes the states of whole months beside the old ones; the load that holds each month afterwards.

    ``rows`` are all latest versions of those months.
    """
    touched = dict.fromkeys(months, load)
    if touched:
        write_days(city_states(rows), f"{path}/ville", MONTH, CITY, load)
        write_days(day_states(rows), f"{path}/jour", MONTH, DAY, load)
    return {**known, **touched}


def read_states(spark: SparkSession, path: str, known: Mapping[date, int], schema: str) -> tuple[DataFrame, DataFrame]:
    """The stored states by city and by date."""
    by_city = read_days(spark, f"{path}/ville", schema, MONTH, known.items())
    return by_city, read_days(spark, f"{path}/jour", DAY_STATES, MONTH, known.items())


def cover(held: Iterable[date], wanted: Iterable[date], stored: Iterable[date]) -> tuple[set[date], set[date]]:
    """Wanted days as whole months that have states and days besides; a month is whole if every day held of it is wanted."""
    held, wanted = set(held), set(wanted)
    whole = (months_of(wanted) & set(stored)) - months_of(held - wanted)
    return whole, {day for day in wanted & held if day.replace(day=1) not in whole}


class Figures:
    """The latest versions with their states: ``held`` days have versions, ``stored`` months have states."""

    def __init__(self, by_city: DataFrame, by_day: DataFrame, current: DataFrame, held: Iterable[date], stored: Iterable[date]):
        self.by_city, self.by_day, self.current = by_city, by_day, current
        self.held, self.stored = set(held), set(stored)

    def _first_day(self, states: DataFrame, rows: DataFrame) -> date | None:
        """The first date among chosen cities; versions are read only for days of months without states."""
        _, rest = cover(self.held, self.held, self.stored)
        firsts = states.agg(F.min("first_day").alias("first"))
        if rest:
            firsts = firsts.unionByName(rows.where(F.col(DAY).isin(sorted(rest))).agg(F.min(DAY).alias("first")))
        return firsts.agg(F.min("first")).first()[0]

    def _days(self, states: DataFrame, rows: DataFrame, spec: FilterSpec) -> set[date]:
        days = self.held
        if spec.period_days is not None:
            first = date.fromisoformat(spec.anchor_date) if spec.anchor_date else self._first_day(states, rows)
            days = {day for day in days if first is not None and day <= first + timedelta(days=spec.period_days - 1)}
        if spec.dates:
            days = days & {date.fromisoformat(day) for day in spec.dates}
        return days

    def select(self, cities: DataFrame, spec: FilterSpec = FilterSpec(), names: DataFrame | None = None) -> DataFrame:
        """The states by city under a dashboard selection; the filters are those of serving.select_forecasts.

        The days held, a few thousand at most, are chosen on the driver.
        """
        chosen = names if names is not None else spec.cities
        states, rows = (serving.chosen_cities(df, cities, chosen) for df in (self.by_city, self.current))
        months, edges = cover(self.held, self._days(states, rows, spec), self.stored)
        found = states.where(F.col(MONTH).isin(sorted(months)))
        if edges:
            found = found.unionByName(city_states(rows.where(F.col(DAY).isin(sorted(edges)))))
        return found.where(F.col(LEVEL).isin(*spec.levels)) if spec.levels else found

    def days(self) -> DataFrame:
        """The states by date, of every level."""
        months, edges = cover(self.held, self.held, self.stored)
        found = self.by_day.where(F.col(MONTH).isin(sorted(months)))
        return found.unionByName(day_states(self.current.where(F.col(DAY).isin(sorted(edges))))) if edges else found


def _mean() -> Column:
    return F.try_divide(F.sum("risk_sum").cast("double"), F.sum("n_scores").cast("double"))


def city_means(states: DataFrame) -> DataFrame:
    """Each city's figures, as the panel of figures takes them."""
    return states.groupBy(CITY).agg(
        _mean().alias("mean"),
        F.max("temperature_max").alias("temperature_max"),
        F.max("precipitation_sum").alias("precipitation_max"),
        F.sum(F.when(F.col(LEVEL) == HIGH, F.col("n")).otherwise(0)).alias("n_high"),
    )


def worst_days(states: DataFrame) -> DataFrame:
    """Each city's date with the highest score, the earlier one on a tie."""
    worst = F.struct(F.col("worst_day").alias(DAY), F.col("risk_max").alias(SCORE), LEVEL)
    first = F.struct(F.col("risk_max").isNull().alias("none"), (-F.col("risk_max")).alias("falling"), "worst_day")
    return states.groupBy(CITY).agg(F.min_by(worst, first).alias("worst")).select(CITY, "worst.*")


def risk_by_day(days: DataFrame) -> DataFrame:
    """Question 4."""
    per_day = days.groupBy(DAY).agg(
        F.round(_mean(), 1).alias("risque_moyen_ce_jour"), F.max("risk_max").alias("risque_maximal_observe_ce_jour")
    )
    return analytics.in_falling_order(per_day)


def cities_above_average(states: DataFrame, cities: DataFrame) -> DataFrame:
    """Question 6."""
    sums = states.where(F.col(CITY).isNotNull()).groupBy(CITY).agg(F.sum("risk_sum").alias("_sum"), F.sum("n_scores").alias("_n"))
    return analytics.above_average(sums, cities)


#: The six questions, from all states. The maxima have the names they have in the rows, so questions 1 and 2 are asked as of rows.
QUESTIONS: dict[str, Callable[[Figures, DataFrame], DataFrame]] = {
    "q1": lambda figures, cities: analytics.hottest_cities(figures.select(cities, ALL), cities),
    "q2": lambda figures, cities: analytics.wettest_cities(figures.select(cities, ALL), cities),
    "q3": lambda figures, cities: analytics.top_by_city(figures.select(cities, ALL), cities, F.round(_mean(), 1), "risque_moyen"),
    "q4": lambda figures, cities: risk_by_day(figures.days()),
    "q5": lambda figures, cities: analytics.worst_in_order(worst_days(figures.select(cities, ALL)), cities),
    "q6": lambda figures, cities: cities_above_average(figures.select(cities, ALL), cities),
}
ALL = FilterSpec(levels=())

#: Panels that states answer, by selection.
PANELS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "kpis": lambda states, cities: serving.kpi_labels(serving.kpi_totals(city_means(states), cities)),
    "map": lambda states, cities: serving.placed_on_map(worst_days(states), cities),
    "top": lambda states, cities: serving.top_means(states.groupBy(CITY).agg(_mean().alias("mean")), cities),
}
