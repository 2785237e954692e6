"""The risk model as column expressions.

A missing measure scores as the worst case: ``least`` skips NULL and orders NaN last, so a clamped
ramp over a missing value is 100. Categories, in contrast, stay missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.model import HIGH, LEVEL_COLOURS, LEVELS, LOW, MEDIUM, Ramp, RiskModel


def _double(value: float) -> str:
    return f"{float(value)!r}D"


def _ramp(measure: str, shape: Ramp) -> str:
    """SQL for a linear rescale to 0..100, clamped at both ends."""
    scaled = f"({measure} - {_double(shape.zero)}) / {_double(shape.full - shape.zero)} * 100D"
    return f"greatest(0D, least(100D, {scaled}))"


def _factors(model: RiskModel) -> dict[str, str]:
    heat, cold = _ramp("temperature_max", model.heat), _ramp("temperature_min", model.cold)
    return {
        "temperature_risk": f"greatest({heat}, {cold})",
        "precipitation_risk": _ramp("precipitation_sum", model.rain),
        "wind_risk": _ramp("wind_gusts_max", model.gust),
    }


def risk_score(model: RiskModel = RiskModel()) -> Column:
    """Weighted blend of the three factors, pulled up by the worst one; rounded half to even."""
    factors = _factors(model).values()
    weights = (model.temperature_weight, model.rain_weight, model.wind_weight)
    blend = " + ".join(f"{factor} * {_double(w)}" for factor, w in zip(factors, weights))
    worst = f"greatest({', '.join(factors)})"
    score = f"({blend}) * {_double(model.blend_weight)} + {worst} * {_double(model.worst_weight)}"
    return F.expr(f"CAST(rint({score}) AS INT)")


def three_bins(value: str, cuts: Sequence[float]) -> Column:
    """Closed-left bins below, between and from the two cuts on; missing stays missing."""
    low, high = cuts
    return F.expr(
        f"CASE WHEN {value} < {low} THEN '{LOW}' WHEN {value} < {high} THEN '{MEDIUM}'"
        f" WHEN {value} >= {high} THEN '{HIGH}' END"
    )


def level_rank(level: Column) -> Column:
    """1, 2, 3 in ascending severity."""
    return F.array_position(F.array(*map(F.lit, LEVELS)), level).cast("int")


def level_colour(level: Column) -> Column:
    shown = F.lit(None).cast("string")
    for name, colour in LEVEL_COLOURS.items():
        shown = F.when(level == name, F.lit(colour)).otherwise(shown)
    return shown


def with_categories(df: DataFrame, model: RiskModel = RiskModel()) -> DataFrame:
    return df.withColumns(
        {
            "temperature_category": three_bins("temperature_max", model.temperature_cuts),
            "precipitation_category": three_bins("precipitation_sum", model.rain_cuts),
            "wind_category": three_bins("wind_gusts_max", model.gust_cuts),
        }
    )


def with_subscores(df: DataFrame, model: RiskModel = RiskModel()) -> DataFrame:
    return df.withColumns({name: F.expr(sql) for name, sql in _factors(model).items()})


def with_risk(df: DataFrame, model: RiskModel = RiskModel()) -> DataFrame:
    """Adds ``risk_score`` and ``risk_level``."""
    scored = df.withColumn("risk_score", risk_score(model))
    return scored.withColumn("risk_level", three_bins("risk_score", model.level_cuts))
