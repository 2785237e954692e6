"""States of months against the rows they stand for, under every kind of selection."""

import itertools
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from galecast.model import FilterSpec
from galecast.operators.ordering import worst_day
from galecast.plans import analytics, current, serving, states

SCHEMA = "ville_id bigint, date_prevision date, temperature_max decimal(5,2), precipitation_sum decimal(6,2), risk_score int, risk_level string, retrieved_at int"
FIRST = date(2024, 1, 20)


def versions():
    """Three cities over 50 days of three months; city 1 has most rows, city 3 starts late, scores tie, are missing, and change by version."""
    rows = []
    for city, day, version in itertools.product((1, 2, 3), range(50), (0, 1)):
        if (city == 2 and day % 3) or (city == 3 and day < 15) or (version and day % 2):
            continue
        score = None if (city + day) % 11 == 0 else (day * 37 * city + version * 41) % 100 // 10 * 10
        level = None if score is None else "faible" if score < 30 else "moyen" if score < 60 else "élevé"
        measure = None if day % 7 == 0 else float(day + city)
        rows.append((city, FIRST + timedelta(days=day), measure, measure, score, level, version))
    return rows


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Loads out of order, each followed by its states; the states of February are left out."""
    path = str(tmp_path_factory.mktemp("states"))
    rows = spark.createDataFrame(versions(), "ville_id bigint, date_prevision date, t double, p double, risk_score int, risk_level string, retrieved_at int")
    rows = rows.select("ville_id", "date_prevision", F.col("t").cast("decimal(5,2)").alias("temperature_max"), F.col("p").cast("decimal(6,2)").alias("precipitation_sum"), "risk_score", "risk_level", "retrieved_at")
    held, known = {}, {}
    parts = (rows.where("retrieved_at = 1"), rows.where("retrieved_at = 0 AND ville_id < 3"), rows.where("ville_id = 3 AND retrieved_at = 0"))
    for load, part in enumerate(parts):
        held = current.merge_latest(spark, f"{path}/rows", SCHEMA, part, held, load)
        months = states.months_of(day for day, at in held.items() if at == load)
        latest = current.read_days(spark, f"{path}/rows", SCHEMA, "date_prevision", [(d, at) for d, at in held.items() if d.replace(day=1) in months])
        known = states.merge_states(path, latest, months, known, load)
    latest = current.read_days(spark, f"{path}/rows", SCHEMA, "date_prevision", held.items())
    tables = states.read_states(spark, path, known, states.city_schema())
    cities = spark.createDataFrame([(1, "A", 1.0, 2.0), (2, "B", 3.0, 4.0), (3, "C", 5.0, 6.0)], "id bigint, city string, latitude double, longitude double")
    lacking = {month: load for month, load in known.items() if month != date(2024, 2, 1)}
    some = states.read_states(spark, path, lacking, states.city_schema())
    return {"all": states.Figures(*tables, latest, held, known), "some": states.Figures(*some, latest, held, lacking)}, latest, cities


SELECTIONS = [
    FilterSpec(levels=()),
    FilterSpec(),
    FilterSpec(cities=("A", "C"), levels=("moyen", "élevé")),
    FilterSpec(cities=("C",), period_days=7),
    FilterSpec(period_days=3, levels=("faible",)),
    FilterSpec(period_days=7, anchor_date="2024-01-31"),
    FilterSpec(period_days=7, dates=("2024-01-20", "2024-01-22", "2024-03-01"), levels=()),
    FilterSpec(dates=("2024-02-10", "2030-01-01")),
    FilterSpec(cities=("nowhere",), period_days=3),
    FilterSpec(period_days=7, levels=()),
]


@pytest.mark.parametrize("which", ["all", "some"])
def test_panels_and_questions_from_states_equal_those_from_rows(stored, which):
    figures, latest, cities = stored
    assert latest.groupBy("ville_id", "date_prevision").count().where("count > 1").isEmpty()
    for name, question in states.QUESTIONS.items() if which == "all" else ():
        assert question(figures[which], cities).collect() == analytics.QUESTIONS[name](latest, cities).collect(), name
    for spec in SELECTIONS if which == "all" else SELECTIONS[2:5]:
        chosen, rows = figures[which].select(cities, spec), serving.select_forecasts(latest, cities, spec, version=None)
        means = states.city_means(chosen).join(states.worst_days(chosen), "ville_id")
        plain = serving._city_means(rows).join(worst_day(rows).select("ville_id", "date_prevision", "risk_score", "risk_level"), "ville_id")
        assert sorted(means.collect()) == sorted(plain.collect()), spec
    for name, panel in states.PANELS.items():
        assert sorted(panel(chosen, cities).collect(), key=str) == sorted(serving.PANELS[name](rows, cities).collect(), key=str), name


def test_whole_months_read_no_versions(stored):
    figures, latest, cities = stored
    versions = set(latest.inputFiles())
    for spec in (FilterSpec(), FilterSpec(period_days=99, levels=())):
        assert not versions & set(figures["all"].select(cities, spec).inputFiles())
    cut = figures["all"].select(cities, FilterSpec(period_days=7))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [date_prevision" in cut


def test_a_load_writes_the_months_it_touches(spark, tmp_path):
    def load(number, days, known):
        rows = spark.createDataFrame([(1, day, 1, "faible", 0) for day in days], "ville_id bigint, date_prevision date, risk_score int, risk_level string, retrieved_at int")
        rows = rows.selectExpr("ville_id", "date_prevision", "CAST(1 AS decimal(5,2)) AS temperature_max", "CAST(1 AS decimal(6,2)) AS precipitation_sum", "risk_score", "risk_level", "retrieved_at")
        return states.merge_states(str(tmp_path), rows, states.months_of(days), known, number)

    known = load(1, [date(2024, 1, 1), date(2024, 2, 29)], {})
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    known = load(2, [date(2024, 2, 1)], known)
    assert known == {date(2024, 1, 1): 1, date(2024, 2, 1): 2}
    assert before.items() <= {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}.items()
    assert load(3, [], known) == known and not list(tmp_path.rglob("load=3"))


def test_cover():
    january, february = date(2024, 1, 1), date(2024, 2, 1)
    held = {january, date(2024, 1, 5), february}
    assert states.cover(held, held, [january, february]) == ({january, february}, set())
    assert states.cover(held, {january, february}, [january, february]) == ({february}, {january})
    assert states.cover(held, held, [january]) == ({january}, {february})
    assert states.cover(held, set(), [january]) == (set(), set())
