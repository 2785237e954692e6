"""The six plausibility rules. A missing value breaks none of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.model import Bounds


def _within(name: str, bounds: tuple[float, float]) -> str:
    low, high = bounds
    return f"{name} IS NULL OR {name} BETWEEN {float(low)!r}D AND {float(high)!r}D"


def rules(bounds: Bounds = Bounds()) -> dict[str, str]:
    """Rule name -> SQL condition a plausible row meets; never NULL, and pushed to the scan."""
    return {
        "temperature_order": "temperature_min IS NULL OR temperature_max IS NULL"
        " OR temperature_min <= temperature_max",
        "temperature_max": _within("temperature_max", bounds.temperature),
        "temperature_min": _within("temperature_min", bounds.temperature),
        "precipitation_sum": _within("precipitation_sum", bounds.precipitation),
        "wind_speed_max": _within("wind_speed_max", bounds.wind),
        "wind_gusts_max": _within("wind_gusts_max", bounds.wind),
    }


def is_plausible(bounds: Bounds = Bounds()) -> Column:
    return F.expr(" AND ".join(f"({condition})" for condition in rules(bounds).values()))


def violations(bounds: Bounds = Bounds()) -> Column:
    """Names of the broken rules, empty for a plausible row."""
    names = (f"CASE WHEN NOT ({met}) THEN '{rule}' END" for rule, met in rules(bounds).items())
    return F.expr(f"array_compact(array({', '.join(names)}))")


def plausible(df: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    return df.where(is_plausible(bounds))


def reject_counts(df: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """Rows broken per rule, rows rejected and rows accepted, in one pass."""
    totals = df.agg(
        *(F.expr(f"count_if(NOT ({met}))").alias(rule) for rule, met in rules(bounds).items()),
        F.count_if(~is_plausible(bounds)).alias("rejected"),
        F.count_if(is_plausible(bounds)).alias("accepted"),
    )
    return totals.unpivot([], list(totals.columns), "rule", "n_rows")
