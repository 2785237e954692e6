"""The dashboard's data: the serving view, its filters and its panels.

Panels take the selected forecasts (keyed by city id) and the city dimension. Aggregates are formed
per city id before names are joined. On an empty selection every panel is empty.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.functions.risk import level_colour, level_rank
from galecast.model import HIGH, FilterSpec
from galecast.operators.ordering import worst_day
from galecast.plans.analytics import CITY, DAY, SCORE, latest, with_city_name

# The columns of the view and of the detail table.
VIEW_COLUMNS = (
    "city", "latitude", "longitude", "date_prevision",
    "temperature_max", "temperature_min", "precipitation_sum", "precipitation_probability_max",
    "wind_speed_max", "wind_gusts_max", "risk_score", "risk_level",
)
DETAIL_COLUMNS = (
    "city", "date_prevision", "temperature_max", "temperature_min",
    "precipitation_sum", "wind_gusts_max", "risk_score", "risk_level",
)


def _located(rows: DataFrame, cities: DataFrame) -> DataFrame:
    places = cities.select(F.col("id").alias(CITY), "city", "latitude", "longitude")
    return rows.join(places, CITY)


def serving_view(current: DataFrame, cities: DataFrame) -> DataFrame:
    """The latest forecasts with city attributes, by date and city."""
    return _located(current, cities).select(*VIEW_COLUMNS).orderBy(DAY, "city")


def filter_options(fact: DataFrame, cities: DataFrame) -> DataFrame:
    """Sorted options of the city and the date filter, from one pass over the forecasts.

    Every version counts: a city and date that occur at all also have a latest version.
    """
    sets = fact.groupingSets([[CITY], [DAY]], CITY, DAY).agg(F.grouping(CITY).alias("_by_date"))
    named = sets.join(cities.select(F.col("id").alias(CITY), "city"), CITY, "left")
    by_date = F.col("_by_date") == 1
    options = named.select(
        F.when(by_date, "date").otherwise("city").alias("filter"),
        F.when(by_date, F.col(DAY).cast("string")).otherwise(F.col("city")).alias("option"),
    )
    return options.where("option IS NOT NULL").orderBy("filter", "option")


def chosen_cities(fact: DataFrame, cities: DataFrame, names: Sequence[str] | DataFrame) -> DataFrame:
    """Fact rows of the named cities; names are resolved to ids before the fact is touched.

    ``names`` may be a relation with a ``city`` column where the list has no bound.
    """
    if isinstance(names, DataFrame):
        ids = cities.join(names.select("city"), "city", "left_semi").select(F.col("id").alias(CITY))
        return fact.join(ids, CITY, "left_semi")
    if not names:
        return fact
    ids = cities.where(F.col("city").isin(*names)).select(F.col("id").alias(CITY))
    return fact.join(ids, CITY, "left_semi")


def within_period(df: DataFrame, days: int | None, anchor_date: str | None = None) -> DataFrame:
    """Rows in the ``days`` days that start at the rows' own first date, or at ``anchor_date``."""
    if days is None:
        return df
    first = F.lit(anchor_date).cast("date") if anchor_date else df.agg(F.min(DAY)).scalar()
    return df.where(F.col(DAY) <= F.date_add(first, days - 1))


def select_forecasts(
    fact: DataFrame,
    cities: DataFrame,
    spec: FilterSpec = FilterSpec(),
    version: Sequence[str] | None = ("retrieved_at",),
    names: DataFrame | None = None,
) -> DataFrame:
    """The latest forecasts that pass the filters: cities, then period, then dates, then levels.

    City and date are the keys of a version, so these filters run below the version choice and
    reach the scan. The level may differ between versions and is tested last. Without ``version`` the rows are
    the latest versions already.
    """
    chosen = chosen_cities(fact, cities, names if names is not None else spec.cities)
    chosen = within_period(chosen, spec.period_days, spec.anchor_date)
    if spec.dates:
        chosen = chosen.where(F.col(DAY).isin(*(F.lit(d).cast("date") for d in spec.dates)))
    current = latest(chosen, version) if version else chosen
    if spec.levels:
        current = current.where(F.col("risk_level").isin(*spec.levels))
    return current


def filter_view(view: DataFrame, spec: FilterSpec) -> DataFrame:
    """The same filters over an already built (and perhaps cached) serving view."""
    if spec.cities:
        view = view.where(F.col("city").isin(*spec.cities))
    view = within_period(view, spec.period_days, spec.anchor_date)
    if spec.dates:
        view = view.where(F.col(DAY).isin(*(F.lit(d).cast("date") for d in spec.dates)))
    if spec.levels:
        view = view.where(F.col("risk_level").isin(*spec.levels))
    return view


def _city_means(current: DataFrame) -> DataFrame:
    return current.groupBy(CITY).agg(
        F.avg(SCORE).alias("mean"),
        F.max("temperature_max").alias("temperature_max"),
        F.max("precipitation_sum").alias("precipitation_max"),
        F.count_if(F.col("risk_level") == HIGH).alias("n_high"),
    )


def _riskiest_first(mean: str) -> list[Column]:
    """Sort keys: the highest mean first, the alphabetically first city on a tie, missing means last."""
    return [F.col(mean).isNull().alias("none"), (-F.col(mean)).alias("falling"), F.col("city")]


def kpis(current: DataFrame, cities: DataFrame) -> DataFrame:
    """Five figures in one row: cities, highest temperature and rain, high-risk rows, riskiest city."""
    return kpi_totals(_city_means(current), cities)


def kpi_totals(means: DataFrame, cities: DataFrame) -> DataFrame:
    """The figures from one row a city."""
    per_city = with_city_name(means, cities)
    totals = per_city.agg(
        F.count("city").alias("n_cities"),
        F.max("temperature_max").alias("temperature_max"),
        F.max("precipitation_max").alias("precipitation_max"),
        F.sum("n_high").cast("bigint").alias("n_high_risk"),
        F.min_by("city", F.struct(*_riskiest_first("mean"))).alias("riskiest_city"),
    )
    return totals.where(F.col("n_cities") > 0)


def kpi_labels(figures: DataFrame) -> DataFrame:
    """The figures as displayed; an exact tie in the second decimal goes to the even digit."""

    def shown(name: str, unit: str) -> Column:
        return F.expr(f"format_number(CAST({name} AS DOUBLE), '0.0') || ' {unit}'")

    return figures.select(
        F.col("n_cities").cast("string").alias("n_cities"),
        shown("temperature_max", "°C").alias("temperature_max"),
        shown("precipitation_max", "mm").alias("precipitation_max"),
        F.col("n_high_risk").cast("string").alias("n_high_risk"),
        "riskiest_city",
    )


def riskiest_city(current: DataFrame, cities: DataFrame) -> DataFrame:
    """The city with the highest mean; the alphabetically first one on a tie."""
    means = with_city_name(current.groupBy(CITY).agg(F.avg(SCORE).alias("mean_risk")), cities)
    return means.select("city", "mean_risk").orderBy(*_riskiest_first("mean_risk")).limit(1)


def map_rows(current: DataFrame, cities: DataFrame) -> DataFrame:
    """Each city's worst forecast with its place and colour."""
    return placed_on_map(worst_day(current, CITY, SCORE, DAY), cities)


def placed_on_map(worst: DataFrame, cities: DataFrame) -> DataFrame:
    return _located(worst, cities).select(
        "city", "latitude", "longitude", DAY, SCORE, "risk_level",
        level_colour(F.col("risk_level")).alias("colour"),
    )


def top_cities(current: DataFrame, cities: DataFrame, n: int = 10) -> DataFrame:
    """The highest means, rounded half to even as the chart does (not as question 3 does)."""
    return top_means(current.groupBy(CITY).agg(F.avg(SCORE).alias("mean")), cities, n)


def top_means(means: DataFrame, cities: DataFrame, n: int = 10) -> DataFrame:
    return (
        with_city_name(means, cities)
        .select("city", (F.rint(F.col("mean") * 10) / 10).alias("risk_score"))
        .orderBy(F.desc("risk_score"), "city")
        .limit(n)
    )


def detail(current: DataFrame, cities: DataFrame) -> DataFrame:
    """The detail table, worst first."""
    return (
        with_city_name(current, cities)
        .select(*DETAIL_COLUMNS)
        .orderBy(F.desc(SCORE), DAY, "city")
    )


def level_distribution(rows: DataFrame) -> DataFrame:
    """Rows per level in ascending severity."""
    counted = rows.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(
        level_rank(F.col("risk_level")).alias("level_rank"), "risk_level", "n_rows"
    ).orderBy("level_rank")


PANELS = {
    "kpis": lambda current, cities: kpi_labels(kpis(current, cities)),
    "map": map_rows,
    "top": top_cities,
    "detail": detail,
}


@contextmanager
def dashboard(
    fact: DataFrame, cities: DataFrame, spec: FilterSpec = FilterSpec(), version: Sequence[str] | None = ("retrieved_at",)
) -> Iterator[dict[str, DataFrame]]:
    """All panels of one selection, which is chosen once and kept while the panels are read."""
    current = select_forecasts(fact, cities, spec, version).persist()
    try:
        yield {name: panel(current, cities) for name, panel in PANELS.items()}
    finally:
        current.unpersist()
