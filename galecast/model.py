"""Fixed values of the data model: labels, thresholds, weights, schemas."""

from __future__ import annotations

from dataclasses import dataclass, field

# Risk labels in ascending order and the colour each is shown in.
LOW, MEDIUM, HIGH = "faible", "moyen", "élevé"
LEVELS = (LOW, MEDIUM, HIGH)
LEVEL_COLOURS = {
    "faible": "#2ecc71",
    "moyen": "#f39c12",
    "élevé": "#e74c3c",
}

# Text that a CSV reader of the pandas family takes as a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The forecast API's daily variables and the constants of a request.
DAILY_VARIABLES = (
    "temperature_2m_max",
    "temperature_2m_min",
    "precipitation_sum",
    "precipitation_probability_max",
    "wind_speed_10m_max",
    "wind_gusts_10m_max",
    "weather_code",
)
FORECAST_DAYS = 7
TIMEZONE = "auto"
BATCH_SIZE = 100

# One row for each stage and run that ended: done, or failed with the reason.
RUNS_SCHEMA = "outcome string, reason string, counts map<string,bigint>, stage string, run_ts string"

# Run identifiers are UTC seconds, e.g. 20260103_060000.
RUN_FORMAT = "yyyyMMdd_HHmmss"
RUN_PATTERN = r"(\d{8}_\d{6})"

# Names the measures carry after flattening, in the order of DAILY_VARIABLES.
MEASURES = (
    "temperature_max",
    "temperature_min",
    "precipitation_sum",
    "precipitation_probability_max",
    "wind_speed_max",
    "wind_gusts_max",
    "weather_code",
)


@dataclass(frozen=True)
class Ramp:
    """A linear rescale: risk 0 at ``zero``, 100 at ``full`` (which may lie below ``zero``)."""

    zero: float
    full: float


@dataclass(frozen=True)
class RiskModel:
    """Scoring parameters; the defaults are fixed values."""

    heat: Ramp = Ramp(25.0, 55.0)
    cold: Ramp = Ramp(10.0, -5.0)
    rain: Ramp = Ramp(0.0, 20.0)
    gust: Ramp = Ramp(0.0, 70.0)
    temperature_weight: float = 0.30
    rain_weight: float = 0.40
    wind_weight: float = 0.30
    blend_weight: float = 0.70
    worst_weight: float = 0.30
    temperature_cuts: tuple[float, float] = (25.0, 40.0)
    rain_cuts: tuple[float, float] = (5.0, 15.0)
    gust_cuts: tuple[float, float] = (40.0, 60.0)
    level_cuts: tuple[int, int] = (30, 60)


@dataclass(frozen=True)
class Bounds:
    """Inclusive plausibility bounds; the defaults are fixed values."""

    temperature: tuple[float, float] = (-10.0, 55.0)
    precipitation: tuple[float, float] = (0.0, 500.0)
    wind: tuple[float, float] = (0.0, 250.0)


# Widths the warehouse stores, checked before a row is loaded.
CITY_PRECISION = {"latitude": "decimal(9,6)", "longitude": "decimal(9,6)"}
FACT_PRECISION = {
    "temperature_max": "decimal(5,2)",
    "temperature_min": "decimal(5,2)",
    "precipitation_sum": "decimal(6,2)",
    "precipitation_probability_max": "decimal(5,2)",
    "wind_speed_max": "decimal(6,2)",
    "wind_gusts_max": "decimal(6,2)",
    "weather_code": "int",
}
CITY_TEXT_LIMITS = {"city": 150, "region": 150}
FACT_TEXT_LIMITS = {
    "temperature_category": 20,
    "precipitation_category": 20,
    "wind_category": 20,
    "risk_level": 20,
}
FACT_KEY = ("ville_id", "date_prevision", "retrieved_at")

# The last column is the run that last set a city's attributes.
CITY_SCHEMA = "id bigint, city string, latitude decimal(9,6), longitude decimal(9,6), region string, updated_by string"
FACT_SCHEMA = (
    "ville_id bigint, date_prevision date, "
    + ", ".join(f"{name} {kind}" for name, kind in FACT_PRECISION.items())
    + ", temperature_category string, precipitation_category string, wind_category string, "
    "risk_score int, risk_level string, retrieved_at timestamp_ntz, run_ts string"
)

# One row for each load or merging of files that ended: the dates, the parts of the dimension and the months of states it wrote, and the last
# city id given.
LEDGER_SCHEMA = "kind string, run_ts string, dates array<date>, parts array<int>, last_id bigint, months array<date>, load int"

# Every daily array is read as text, so that one bad value costs that value and not the document.
DAILY_TYPE = "struct<time:array<string>," + ",".join(f"{v}:array<string>" for v in DAILY_VARIABLES) + ">"
WEATHER_TYPE = f"struct<daily:{DAILY_TYPE}>"
# A record's response is read as text first, then as WEATHER_TYPE.
RECORD_TYPE = "city string, lat string, lng string, weather_raw string"

# Source order of a flattened row: input split, record inside it, day inside the record.
ORDINAL = ("source_split", "source_row", "day_index")
_ROW = (
    "city string, latitude double, longitude double, date_prevision date, "
    + ", ".join(f"{m} double" for m in MEASURES)
    + ", source_split string, source_row bigint, day_index int, retrieved_at timestamp_ntz, "
    "region string, population double, "
)
# ``text`` holds a record that was set aside, as received; its row has no values. ``copies`` counts the rows of a row's key.
SILVER_SCHEMA = _ROW + "violations array<string>, accepted boolean, text string, copies bigint, run_ts string"
GOLD_SCHEMA = _ROW + (
    "temperature_category string, precipitation_category string, wind_category string, "
    "risk_score int, risk_level string, run_ts string"
)


def column_names(schema: str) -> list[str]:
    return [column.split(" ")[0] for column in schema.split(", ")]


@dataclass(frozen=True)
class FilterSpec:
    """A dashboard selection. An empty tuple means no filter, for cities, dates and levels alike.

    ``period_days`` counts from the first date present among the selected cities, or from
    ``anchor_date`` where one is given.
    """

    cities: tuple[str, ...] = ()
    period_days: int | None = None
    dates: tuple[str, ...] = ()
    levels: tuple[str, ...] = field(default=LEVELS)
    anchor_date: str | None = None
