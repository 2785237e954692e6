"""Golden values of scoring, categories, plausibility and coercion."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from galecast.functions.coerce import fits, na_to_null, nan_to_null, store_as, strict_date, strict_double
from galecast.functions.plausibility import is_plausible, reject_counts, violations
from galecast.functions.risk import (
    level_colour,
    level_rank,
    three_bins,
    with_categories,
    with_risk,
    with_subscores,
)
from galecast.model import NA_TOKENS

MEASURES = "temperature_max double, temperature_min double, precipitation_sum double, wind_gusts_max double"

# temperature_max, temperature_min, precipitation_sum, wind_gusts_max, score, level
SCORES = [
    (25, 10, 0, 0, 0, "faible"),
    (55, 20, 20, 70, 100, "élevé"),
    (40, 15, 10, 35, 50, "moyen"),
    (55, 15, 0, 0, 51, "moyen"),
    (20, -5, 0, 0, 51, "moyen"),
    (20, 15, 20, 0, 58, "moyen"),
    (20, 15, 0, 70, 51, "moyen"),
    (None, 15, 0, 0, 51, "moyen"),
    (20, None, 0, 0, 51, "moyen"),
    (20, 15, None, 0, 58, "moyen"),
    (20, 15, 0, None, 51, "moyen"),
    (None, None, None, None, 100, "élevé"),
    (31, 12, 4.2, 33.5, 34, "moyen"),
    (24, 2.5, 7.5, 21, 42, "moyen"),
    (25, 15, 1.0, 7, 6, "faible"),
    (25, 15, 1.5, 28, 22, "faible"),
    (25, 15, 2.0, 49, 38, "moyen"),
    (25, 15, 2.5, 70, 54, "moyen"),
]


def relation(spark, values, schema):
    numbers = [tuple(float(x) if isinstance(x, int) else x for x in row) for row in values]
    return spark.createDataFrame([(i, *row) for i, row in enumerate(numbers)], "i int, " + schema).orderBy("i")


def test_scores_and_levels(spark):
    df = with_risk(relation(spark, [s[:4] for s in SCORES], MEASURES))
    got = [(r.risk_score, r.risk_level) for r in df.orderBy("i").collect()]
    assert got == [s[4:] for s in SCORES]


def test_nan_scores_like_missing(spark):
    df = with_risk(relation(spark, [(math.nan, 15, 0, 0)], MEASURES))
    assert df.first().risk_score == 51


def python_score(tmax, tmin, rain, gust):
    """The published formula in plain Python."""

    def clamp(x):
        return 100.0 if x is None else max(0.0, min(100.0, x))

    heat = clamp(None if tmax is None else (tmax - 25) / 30 * 100)
    cold = clamp(None if tmin is None else (10 - tmin) / 15 * 100)
    t, p, w = max(heat, cold), clamp(None if rain is None else rain / 20 * 100), clamp(
        None if gust is None else gust / 70 * 100
    )
    return round((t * 0.30 + p * 0.40 + w * 0.30) * 0.70 + max(t, p, w) * 0.30)


measure = st.one_of(st.none(), st.floats(-20, 260, allow_nan=False), st.integers(-10, 80).map(float))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(measure, measure, measure, measure), min_size=50, max_size=200))
def test_scores_follow_the_formula(spark, values):
    df = with_subscores(with_risk(relation(spark, values, MEASURES)))
    for row in df.collect():
        inputs = values[row.i]
        assert row.risk_score == python_score(*inputs)
        assert 0 <= row.risk_score <= 100
        assert all(0 <= row[c] <= 100 for c in ("temperature_risk", "precipitation_risk", "wind_risk"))


def test_score_rises_with_rain_and_gusts(spark):
    grid = [(30, 12, rain, gust) for rain in (0, 1, 7.3, 19.9, 20, 40) for gust in (0, 3, 35, 70, 90)]
    df = with_risk(relation(spark, grid, MEASURES))
    score = {(r.precipitation_sum, r.wind_gusts_max): r.risk_score for r in df.collect()}
    for (rain, gust), value in score.items():
        assert all(value <= other for (a, b), other in score.items() if a >= rain and b >= gust)


def test_category_edges(spark):
    values = [
        (24.99, None, 4.99, 39.99), (25, None, 5, 40), (39.99, None, 14.99, 59.99),
        (40, None, 15, 60), (None, None, None, None),
    ]
    df = with_categories(relation(spark, values, MEASURES)).orderBy("i")
    low, mid, high = "faible", "moyen", "élevé"
    got = [(r.temperature_category, r.precipitation_category, r.wind_category) for r in df.collect()]
    assert got == [(low,) * 3, (mid,) * 3, (mid,) * 3, (high,) * 3, (None,) * 3]


def test_level_edges_rank_and_colour(spark):
    df = spark.createDataFrame([(s,) for s in (0, 29, 30, 59, 60, 100)], "s int")
    df = df.withColumn("l", three_bins("s", (30, 60)))
    got = df.select("l", level_rank(F.col("l")), level_colour(F.col("l"))).collect()
    assert [tuple(r) for r in got] == [
        ("faible", 1, "#2ecc71"), ("faible", 1, "#2ecc71"), ("moyen", 2, "#f39c12"),
        ("moyen", 2, "#f39c12"), ("élevé", 3, "#e74c3c"), ("élevé", 3, "#e74c3c"),
    ]


# temperature_max, temperature_min, precipitation_sum, wind_speed_max, wind_gusts_max, broken rules
PLAUSIBILITY = [
    (20, 20, 0, 0, 0, []),
    (20, 21, 0, 0, 0, ["temperature_order"]),
    (20, None, 0, 0, 0, []),
    (55, 0, 0, 0, 0, []),
    (55.01, 0, 0, 0, 0, ["temperature_max"]),
    (0, -10, 0, 0, 0, []),
    (0, -10.01, 0, 0, 0, ["temperature_min"]),
    (0, 0, -0.1, 0, 0, ["precipitation_sum"]),
    (0, 0, 500, 0, 0, []),
    (0, 0, 500.1, 0, 0, ["precipitation_sum"]),
    (0, 0, 0, 250, 250, []),
    (0, 0, 0, 250.1, 250.1, ["wind_speed_max", "wind_gusts_max"]),
    (0, 0, 0, -1, -1, ["wind_speed_max", "wind_gusts_max"]),
    (None, None, None, None, None, []),
]


def test_plausibility(spark):
    schema = (
        "temperature_max double, temperature_min double, precipitation_sum double, "
        "wind_speed_max double, wind_gusts_max double"
    )
    df = relation(spark, [p[:5] for p in PLAUSIBILITY], schema)
    judged = df.select("i", violations().alias("v"), is_plausible().alias("ok")).orderBy("i").collect()
    assert [r.v for r in judged] == [p[5] for p in PLAUSIBILITY]
    assert [r.ok for r in judged] == [not p[5] for p in PLAUSIBILITY]
    counts = {r.rule: r.n_rows for r in reject_counts(df).collect()}
    assert counts["accepted"] + counts["rejected"] == len(PLAUSIBILITY)
    assert counts["accepted"] == sum(not p[5] for p in PLAUSIBILITY)


def test_numbers(spark):
    cases = {
        " 2 ": 2.0, "\t2\n": 2.0, "1e2": 100.0, "-3.5": -3.5, ".5": 0.5, "5.": 5.0, "+1": 1.0,
        "abc": None, "1d": None, "1f": None, "0x10": None, "1_000": None, "": None, "NaN": None,
        "inf": None, "1,5": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    assert [r[0] for r in df.select(strict_double(F.col("s"))).collect()] == list(cases.values())


def test_dates(spark):
    cases = ["2026-01-03", "2026-02-30", "2026-01-03T05:00", "01/02/2026", "x", None]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r[0] for r in df.select(strict_date(F.col("s")).cast("string")).collect()]
    assert got == ["2026-01-03", None, None, None, None, None]


def test_missing_tokens(spark):
    assert len(NA_TOKENS) == 19
    df = spark.createDataFrame([(t,) for t in (*NA_TOKENS, "Nador", None)], "s string")
    kept = [r[0] for r in df.select(na_to_null(F.col("s"))).collect()]
    assert kept == [None] * 19 + ["Nador", None]
    nan = spark.createDataFrame([(math.nan,), (1.0,), (None,)], "x double").select(nan_to_null(F.col("x")))
    assert [r[0] for r in nan.collect()] == [None, 1.0, None]


@pytest.mark.parametrize(
    ("value", "kind", "stored"),
    [
        (12.345, "decimal(5,2)", "12.35"),
        (-12.345, "decimal(5,2)", "-12.35"),
        (999.99, "decimal(5,2)", "999.99"),
        (999.994, "decimal(5,2)", "999.99"),
        (999.995, "decimal(5,2)", None),
        (1000.0, "decimal(5,2)", None),
        (-9999.995, "decimal(6,2)", None),
        (123.4567894, "decimal(9,6)", "123.456789"),
        (3.0, "int", "3"),
        (2147483648.0, "int", None),
        (math.inf, "decimal(5,2)", None),
        (None, "decimal(5,2)", None),
    ],
)
def test_warehouse_precision(spark, value, kind, stored):
    df = spark.createDataFrame([(value,)], "x double")
    got, fit = df.select(store_as("x", kind).cast("string"), fits("x", kind)).first()
    assert got == stored
    assert fit == (value is None or stored is not None)
