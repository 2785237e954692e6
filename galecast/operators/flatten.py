"""Flattening of nested forecast documents into one row per city and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.functions.coerce import na_to_null, nan_to_null, strict_date, strict_double
from galecast.model import DAILY_VARIABLES, MEASURES


def has_complete_days(daily: str = "weather_raw.daily") -> Column:
    """True where every variable has a value slot for every day. Surplus slots are allowed."""
    days = F.size(F.col(f"{daily}.time"))
    complete = F.col(f"{daily}.time").isNotNull()
    for variable in DAILY_VARIABLES:
        complete = complete & (F.size(F.col(f"{daily}.{variable}")) >= days)
    return F.coalesce(complete, F.lit(False))


def explode_arrays(df: DataFrame, index: Column, arrays: dict[str, Column], *keep: str) -> DataFrame:
    """One row per element of ``index``, with the element of each array at the same place.

    The elements are put side by side before they are exploded, so no row carries whole arrays.
    """

    def together(day: Column, place: Column) -> Column:
        values = (F.get(values, place).alias(name) for name, values in arrays.items())
        return F.struct(place.alias("day_index"), day.alias("_day"), *values)

    return df.select(*keep, F.inline(F.transform(index, together)))


def flatten_forecasts(records: DataFrame) -> DataFrame:
    """Typed (city, day) rows of complete records; text that does not parse becomes NULL.

    A record without complete days gives one row, without date and values, that carries its text.
    """
    complete = has_complete_days()
    arrays = {
        name: F.col(f"weather_raw.daily.{variable}")
        for name, variable in zip(MEASURES, DAILY_VARIABLES)
    }
    days = F.when(complete, F.col("weather_raw.daily.time")).otherwise(F.array(F.lit(None).cast("string")))
    rows = explode_arrays(
        records.withColumn("text", F.when(~complete, F.col("text"))),
        days,
        arrays,
        "city", "lat", "lng", "text", "run_ts", "source_split", "source_row",
    )
    return rows.select(
        na_to_null(F.col("city")).alias("city"),
        nan_to_null(strict_double(F.col("lat"))).alias("latitude"),
        nan_to_null(strict_double(F.col("lng"))).alias("longitude"),
        strict_date(F.col("_day")).alias("date_prevision"),
        *(F.when(F.col("text").isNull(), nan_to_null(strict_double(F.col(m)))).alias(m) for m in MEASURES),
        "text", "run_ts", "source_split", "source_row", "day_index",
    )
