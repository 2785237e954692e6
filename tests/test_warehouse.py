"""Loads that fail, arrive late or repeat; upkeep; tables other sessions can name; counts under lost files."""

import datetime
import json
import os
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from galecast.plans import analytics, pipeline, states, warehouse
from galecast.plans.analytics import QUESTIONS
from test_pipeline import LATER, RUN, put, record

EARLIER = "20260102_060000"
LAST = "20260105_060000"
DAYS = ["2026-01-03", "2026-01-04"]
CITIES = [("A", 1, 2, "R1", 1), ("Fès", 3, 4, "R2", 2)]


def seen(spark, lake):
    """Everything a reader can ask for, in a form that can be compared."""
    known = warehouse.contents(spark, lake)
    cities, current = warehouse.current_cities(spark, lake, known), warehouse.latest_facts(spark, lake, known)
    figures = warehouse.figures(spark, lake, known)
    answers = {name: list(map(str, states.QUESTIONS[name](figures, cities).collect())) for name in ("q2", "q5")}
    assert answers == {name: list(map(str, QUESTIONS[name](current, cities).collect())) for name in answers}
    stored = warehouse.facts(spark, lake, known)
    rows = sorted(map(str, stored.collect()))
    assert sorted(map(str, analytics.latest(stored).select(*sorted(stored.columns)).collect())) == sorted(map(str, current.select(*sorted(stored.columns)).collect()))
    return rows, sorted(map(str, cities.collect())), answers


def files(path):
    return {str(p): (p.stat().st_mtime_ns, p.stat().st_size) for p in Path(path).rglob("*.parquet")}


def test_loads_that_fail_arrive_late_or_touch_little(spark, tmp_path, monkeypatch):
    lake = put(tmp_path, RUN, CITIES, [record("A", DAYS), record("Fès", DAYS)])
    pipeline.run_all(spark, lake)
    before = seen(spark, lake)
    put(tmp_path, LATER, [("A", 5, 6, "NEW", 1), ("B", 7, 8, "R3", 1)], [record("A", DAYS[1:], 5.0, 6.0, precipitation_sum=[20.0]), record("B", DAYS[1:])])
    with monkeypatch.context() as broken:
        broken.setattr(warehouse, "missing_facts", lambda *_: True)
        with pytest.raises(ValueError, match="were lost"):
            pipeline.run_all(spark, lake, LATER)
    assert (tmp_path / f"entrepot/previsions/date_prevision={DAYS[1]}/load=2").exists()
    assert seen(spark, lake) == before
    warehouse.register_views(spark, lake)
    assert spark.sql("SELECT (SELECT count(*) FROM villes) + (SELECT count(*) FROM previsions)").first()[0] == 6
    assert warehouse.constraint_report(spark, lake).isEmpty()

    # The repeat has a number of its own and shows everything; the day it does not touch stays as it was.
    kept = files(tmp_path / f"entrepot/derniers/date_prevision={DAYS[0]}")
    cities = files(tmp_path / "entrepot/villes")
    assert pipeline.run_pending(spark, lake)[LATER] == {"inserted": 2, "rejected": 0, "stored_before": 0}
    known = warehouse.contents(spark, lake)
    assert {str(day): loads for day, loads in known.dates.items()} == {DAYS[0]: [1], DAYS[1]: [1, 3]}
    assert {str(day): load for day, load in known.latest.items()} == {DAYS[0]: 1, DAYS[1]: 3} and known.last_id == 3
    assert files(tmp_path / f"entrepot/derniers/date_prevision={DAYS[0]}") == kept
    assert cities.items() <= files(tmp_path / "entrepot/villes").items()
    untouched = {part: load for part, load in known.parts.items() if load == 1}
    assert set(known.parts.values()) <= {1, 3} and (untouched or len(known.parts) == 2)
    rows, places, answers = seen(spark, lake)
    assert len(rows) == 6 and "20.00" in answers["q2"][0] and "NEW" in " ".join(places)

    # An older run adds versions, but changes neither the latest ones nor the cities.
    put(tmp_path, EARLIER, [("A", 9, 9, "OLD", 1)], [record("A", DAYS, precipitation_sum=[90.0, 90.0])])
    pipeline.run_all(spark, lake, EARLIER)
    late = seen(spark, lake)
    assert len(late[0]) == 8 and late[1:] == (places, answers)
    assert warehouse.contents(spark, lake).parts == known.parts

    # Merging the files of a date, and removing what no reader needs, changes no answer.
    assert len(warehouse.merge_files(spark, lake, most=2)) == 1 and warehouse.merge_files(spark, lake, most=2) == []
    assert seen(spark, lake) == late
    merged = warehouse.contents(spark, lake)
    assert sorted(len(loads) for loads in merged.dates.values()) == [1, 2]
    assert warehouse.remove_unused(spark, lake) >= 4 and warehouse.remove_unused(spark, lake) == 0
    assert seen(spark, lake) == late
    assert not (tmp_path / f"entrepot/previsions/date_prevision={DAYS[1]}/load=2").exists()


def test_files_of_a_date_stay_bounded(spark, tmp_path):
    """Thirty loads of one date, with upkeep as it would be run."""
    lake, days = warehouse.Lake(str(tmp_path)), [datetime.date(2026, 1, 3)]
    fact = spark.sql(
        """SELECT CAST(1 AS bigint) AS ville_id, DATE '2026-01-03' AS date_prevision, CAST(1 AS decimal(5,2)) AS temperature_max, CAST(1 AS decimal(5,2)) AS temperature_min,
        CAST(1 AS decimal(6,2)) AS precipitation_sum, CAST(1 AS decimal(5,2)) AS precipitation_probability_max, CAST(1 AS decimal(6,2)) AS wind_speed_max,
        CAST(1 AS decimal(6,2)) AS wind_gusts_max, 1 AS weather_code, 'a' AS temperature_category, 'b' AS precipitation_category, 'c' AS wind_category,
        1 AS risk_score, 'faible' AS risk_level, TIMESTAMP_NTZ '2026-01-01 00:00:00' AS retrieved_at, 'r' AS run_ts"""
    )
    most = 0
    for _ in range(30):
        load = warehouse.begin(spark, lake)
        fact.withColumn("load", F.lit(load)).coalesce(1).write.mode("append").partitionBy("date_prevision", "load").parquet(lake.facts)
        warehouse.finish(spark, lake, load, "load", "r", days, [], 0)
        if load % 8 == 0:
            most = max(most, len(warehouse.facts(spark, lake).inputFiles()))
            warehouse.merge_files(spark, lake)
            warehouse.remove_unused(spark, lake)
    assert warehouse.facts(spark, lake).count() == 30 and most <= 2 * warehouse.MOST_LOADS + 1
    assert len(files(lake.facts)) <= warehouse.MOST_LOADS + 1


def test_other_sessions_can_name_the_tables(spark, tmp_path):
    lake = put(tmp_path, RUN, CITIES, [record("A", DAYS), record("Fès", DAYS)])
    pipeline.run_all(spark, lake)
    spark.sql("CREATE DATABASE IF NOT EXISTS meteo")
    try:
        warehouse.declare_tables(spark, lake, "meteo")
        other = spark.newSession()
        count = "SELECT count(*) FROM meteo.previsions JOIN meteo.villes ON id = ville_id WHERE date_prevision = DATE '2026-01-04'"
        assert other.sql(count).first()[0] == 2
        put(tmp_path, LATER, CITIES, [record("A", DAYS)])
        pipeline.run_all(spark, lake, LATER)
        for _ in range(2):
            warehouse.declare_tables(spark, lake, "meteo")
            assert other.sql(count).first()[0] == 3
        spark.sql("DROP TABLE meteo.villes")
        spark.sql("CREATE TABLE meteo.villes (id int, part int, load int) USING parquet PARTITIONED BY (part, load)")
        with pytest.raises(ValueError, match="id bigint"):
            warehouse.declare_tables(spark, lake, "meteo")
    finally:
        spark.sql("DROP DATABASE meteo CASCADE")


LOSS = """
import glob, json, os, sys
from pyspark.sql import SparkSession
from galecast.plans import pipeline, warehouse
root, local = sys.argv[1:3]
spark = (SparkSession.builder.master("local[1,4]").config("spark.ui.enabled", "false").config("spark.local.dir", local)
         .config("spark.sql.shuffle.partitions", "3").config("spark.sql.adaptive.enabled", "false").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
whole, lake = pipeline.enrich, warehouse.Lake(root)

def losing(batches):
    for batch in batches:
        yield batch
    if not os.path.exists(root + "/lost"):
        open(root + "/lost", "w").close()
        for name in glob.glob(local + "/**/shuffle_*", recursive=True):
            os.remove(name)

def enrich(df, reference, on):
    joined = whole(df, reference, on)
    return joined.mapInArrow(losing, joined.schema)

first = pipeline.build_silver(spark, lake)
pipeline.enrich = enrich
second = pipeline.build_silver(spark, lake)
print("RESULT", json.dumps([first, second, os.path.exists(root + "/lost")]))
"""


def test_counts_are_exact_when_shuffle_files_are_lost(tmp_path):
    names = [f"C{i}" for i in range(40)]
    put(tmp_path, RUN, [(n, 1, 2, "R", 1) for n in names], [record(n, DAYS) for n in names] * 2 + [{"error": True}])
    env = {**os.environ, "PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    run = subprocess.run([sys.executable, "-c", textwrap.dedent(LOSS), str(tmp_path), str(tmp_path / "local")], env=env, capture_output=True, text=True, timeout=300)
    line = next((x for x in run.stdout.splitlines() if x.startswith("RESULT")), run.stderr[-2000:])
    first, second, lost = json.loads(line.removeprefix("RESULT"))
    assert lost and first == second == {"broken": 1, "flattened": 160, "accepted": 80, "rejected": 0, "duplicates": 80}
