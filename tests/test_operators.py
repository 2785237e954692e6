"""Operators against brute force on small, skewed fixtures; and the shape of their plans."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from galecast.functions.coerce import once
from galecast.model import FilterSpec
from galecast.operators import merge, quality
from galecast.operators.ordering import (
    keep_first,
    key_position,
    latest_versions,
    require_no_rows,
    require_rows,
    split_position,
)
from galecast.plans import analytics, serving

DAY = datetime.date(2026, 1, 1)


def plan(df):
    """The executed plan, after running it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def some_facts(n=600, hot=0.4, cities=9):
    """Versions of forecasts in which one city holds a large part of the rows."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        city = 0 if rng.random() < hot else rng.randrange(cities)
        day = DAY + datetime.timedelta(days=rng.randrange(6))
        score = rng.choice([None, *range(0, 101, 5)]) if i % 50 == 0 else rng.randrange(0, 101, 5)
        level = None if score is None else ("faible" if score < 30 else "moyen" if score < 60 else "élevé")
        made = datetime.datetime(2026, 1, 1) + datetime.timedelta(minutes=i)
        heat = None if i % 9 == 0 else float(rng.randrange(50))
        rows.append((city, day, made, score, level, heat, 1.0, float(rng.randrange(30)), 0.0, 0.0, 0.0))
    return rows


FACT = (
    "ville_id bigint, date_prevision date, retrieved_at timestamp_ntz, risk_score int, risk_level string, "
    "temperature_max double, temperature_min double, precipitation_sum double, "
    "precipitation_probability_max double, wind_speed_max double, wind_gusts_max double"
)
NAMES = [(i, f"V{(i * 7) % 10}", float(i), -float(i)) for i in range(10)]


@pytest.fixture(scope="module")
def store(spark):
    rows = some_facts()
    facts = spark.createDataFrame(rows, FACT).repartition(5)
    cities = spark.createDataFrame(NAMES, "id bigint, city string, latitude double, longitude double")
    newest = {}
    for row in rows:
        newest[row[:2]] = max(newest.get(row[:2], row), row, key=lambda r: r[2])
    return facts, cities, list(newest.values())


def test_positions_cover_sparse_keys(spark):
    rng = random.Random(3)
    keys = {rng.randrange(2**62) for _ in range(200)} | set(range(50)) | {2**63 - 1, 2**21, 2**42, 2**42 + 1}
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(7)
    got = {r.k: r.position for r in key_position(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}
    assert {r.k: r.position for r in key_position(df, "k", bits=5).collect()} == got
    with pytest.raises(ValueError):
        key_position(df, "k", bits=1)
    with pytest.raises(Exception, match="has no position"):
        key_position(df.unionByName(df.limit(1).select(F.lit(None).cast("bigint").alias("k"))), "k").collect()


def test_no_window_group_of_dense_keys_exceeds_a_digit(spark):
    keys = spark.range(1_500_000).select(F.shiftright("id", 16).alias("piece"))
    assert keys.groupBy("piece").count().agg(F.max("count")).first()[0] <= 1 << 16
    numbered = key_position(spark.range(200_000).withColumnRenamed("id", "k"), "k")
    assert numbered.where("k <> position").isEmpty()
    assert "SinglePartition" not in numbered._jdf.queryExecution().executedPlan().toString()


def test_positions_of_split_rows(spark):
    rows = [(f"f{s}", r) for s in range(5) for r in range(s * 3)]
    df = spark.createDataFrame(rows, "split string, row bigint").repartition(4)
    got = {(r.split, r.row): r.position for r in split_position(df, "split", "row").collect()}
    assert got == {key: i for i, key in enumerate(sorted(rows))}


def test_positions_inside_a_large_split(spark):
    rows = spark.range(140_000).select(F.concat(F.lit("f"), F.col("id") % 2).alias("split"), F.col("id").alias("row"))
    numbered = split_position(rows.repartition(5), "split", "row")
    assert numbered.where("position <> (row % 2) * 70000 + row div 2").isEmpty()


def test_keep_first_and_latest(spark, store):
    facts, _, newest = store
    current = latest_versions(facts)
    assert sorted((r.ville_id, r.date_prevision, r.retrieved_at) for r in current.collect()) == sorted(
        r[:3] for r in newest
    )
    rows = [(None, 2), (None, 1), ("a", 3), ("a", 0)]
    first = keep_first(spark.createDataFrame(rows, "k string, o int"), ["k"], ["o"])
    assert sorted(tuple(r) for r in first.collect() if r.k) == [("a", 0)]
    assert [r.o for r in first.collect() if r.k is None] == [1]


def test_version_choice_is_limited_below_the_shuffle(store):
    text = plan(analytics.latest(store[0]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Partial") > text.index("Exchange")


def test_questions(store):
    facts, cities, newest = store
    current = analytics.latest(facts)
    name = {i: n for i, n, _, _ in NAMES}
    scores = {}
    for r in newest:
        if r[3] is not None:
            scores.setdefault(r[0], []).append(r[3])
    every = [s for values in scores.values() for s in values]
    above = {name[c] for c, v in scores.items() if sum(v) * len(every) > sum(every) * len(v)}
    got = analytics.cities_above_average(current, cities)
    assert {r.city for r in got.collect()} == above
    assert "ReusedExchange" in plan(got)

    worst = {r.city: (r.risk_score, r.periode_la_plus_a_risque) for r in analytics.worst_day_by_city(current, cities).collect()}
    for city, values in scores.items():
        days = [r[1] for r in newest if r[0] == city and r[3] == max(values)]
        assert worst[name[city]] == (max(values), min(days))

    days = analytics.risk_by_day(current).collect()
    assert [d.risque_moyen_ce_jour for d in days] == sorted((d.risque_moyen_ce_jour for d in days), reverse=True)
    assert len(analytics.riskiest_cities(current, cities).collect()) == 9


def test_rounding_differs_between_question_and_chart(spark):
    scores = [45, 45, 45, 46]
    rows = [(1, DAY + datetime.timedelta(days=i), s) for i, s in enumerate(scores)]
    current = spark.createDataFrame(rows, "ville_id bigint, date_prevision date, risk_score int")
    cities = spark.createDataFrame([(1, "A")], "id bigint, city string")
    assert analytics.riskiest_cities(current, cities).first().risque_moyen == 45.3
    assert serving.top_cities(current, cities).first().risk_score == 45.2


def test_labels_round_like_python(spark):
    values = [12.25, 0.15, 0.35, 40.75, 31.4, -0.04, 1234.56]
    schema = "n_cities bigint, temperature_max double, precipitation_max decimal(6,2), n_high_risk bigint, riskiest_city string"
    df = spark.createDataFrame([(1, v, None, 2, "A") for v in values], schema)
    labels = serving.kpi_labels(df).collect()
    assert [r.temperature_max for r in labels] == [f"{v:.1f} °C" for v in values]
    assert {r.precipitation_max for r in labels} == {None}


SPECS = [
    FilterSpec(),
    FilterSpec(cities=("V7", "V4", "nowhere")),
    FilterSpec(period_days=3),
    FilterSpec(cities=("V1",), period_days=3),
    FilterSpec(period_days=7, dates=("2026-01-02", "2026-01-05")),
    FilterSpec(levels=("élevé",)),
    FilterSpec(levels=()),
    FilterSpec(cities=("V0", "V7"), period_days=3, dates=("2026-01-01",), levels=("moyen", "faible")),
    FilterSpec(period_days=3, anchor_date="2026-01-03"),
]


@pytest.mark.parametrize("spec", SPECS)
def test_selection_below_the_version_choice_equals_filtering_the_view(store, spec):
    facts, cities, newest = store
    name = {i: n for i, n, _, _ in NAMES}
    chosen = [r for r in newest if not spec.cities or name[r[0]] in spec.cities]
    if spec.period_days:
        first = datetime.date.fromisoformat(spec.anchor_date) if spec.anchor_date else min(r[1] for r in chosen)
        chosen = [r for r in chosen if r[1] <= first + datetime.timedelta(days=spec.period_days - 1)]
    chosen = [r for r in chosen if not spec.dates or str(r[1]) in spec.dates]
    chosen = [r for r in chosen if not spec.levels or r[4] in spec.levels]
    expected = sorted((name[r[0]], r[1]) for r in chosen)

    selected = serving.select_forecasts(facts, cities, spec)
    assert sorted((r.city, r.date_prevision) for r in serving.detail(selected, cities).collect()) == expected
    view = serving.filter_view(serving.serving_view(analytics.latest(facts), cities), spec)
    assert sorted((r.city, r.date_prevision) for r in view.collect()) == expected

    figures = serving.kpis(selected, cities).collect()
    assert len(figures) == (1 if chosen else 0)
    if chosen:
        assert figures[0].n_cities == len({r[0] for r in chosen})
        assert figures[0].n_high_risk == sum(r[4] == "élevé" for r in chosen)
        top = serving.riskiest_city(selected, cities).first()
        assert figures[0].riskiest_city == top.city


def test_names_may_be_a_relation(spark, store):
    facts, cities, _ = store
    names = spark.createDataFrame([("V7",), ("V4",)], "city string")
    by_relation = serving.select_forecasts(facts, cities, names=names)
    by_list = serving.select_forecasts(facts, cities, FilterSpec(cities=("V7", "V4")))
    assert sorted(map(tuple, by_relation.collect()), key=str) == sorted(map(tuple, by_list.collect()), key=str)


def test_options_read_the_facts_once(spark, store, tmp_path):
    facts, cities, newest = store
    facts.write.parquet(str(tmp_path / "f"))
    options = serving.filter_options(spark.read.parquet(str(tmp_path / "f")), cities)
    name = {i: n for i, n, _, _ in NAMES}
    expected = sorted({("city", name[r[0]]) for r in newest} | {("date", str(r[1])) for r in newest})
    assert [tuple(r) for r in options.collect()] == expected
    assert plan(options).count("FileScan") == 1


def test_filters_reach_the_scan(spark, store, tmp_path):
    facts, cities, _ = store
    facts.write.parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    spec = FilterSpec(dates=("2026-01-02",), levels=("moyen",))
    text = plan(serving.select_forecasts(stored, cities, spec))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "EqualTo(date_prevision,2026-01-02)" in scan or "In(date_prevision" in scan
    assert "risk_level" not in scan.split("PushedFilters")[1].split("ReadSchema")[0]


def test_upsert(spark):
    schema = "id bigint, city string, latitude double, longitude double, region string"
    old = spark.createDataFrame([(1, "A", 1.0, 1.0, "r"), (7, "B", 2.0, 2.0, "s")], schema)
    sent = [(9, "A", 5.0, 5.0, None), (5, "D", 1.0, 1.0, "t"), (3, "C", 1.0, 1.0, "t")]
    incoming = spark.createDataFrame(sent, schema)
    after = merge.upsert_cities(old, incoming, lambda new: key_position(new, "id"))
    assert sorted(tuple(r) for r in after.collect()) == [
        (1, "A", 5.0, 5.0, None), (7, "B", 2.0, 2.0, "s"), (8, "C", 1.0, 1.0, "t"), (9, "D", 1.0, 1.0, "t"),
    ]
    dated = lambda df, run: df.withColumn("run", F.lit(run))
    for run, region in (("2", None), ("1", None), ("0", "r")):
        newer = merge.upsert_cities(dated(old, "1"), dated(incoming, run), lambda new: key_position(new, "id"), version="run")
        assert newer.where("city = 'A'").first()["region"] == region
    fresh = merge.upsert_cities(old.limit(0), incoming, lambda new: key_position(new, "id"))
    assert sorted(r.id for r in fresh.collect()) == [1, 2, 3]


def test_insert_absent_shuffles_the_batch_once(spark):
    keys = ["k", "d"]
    batch = spark.createDataFrame([(1, 1, 5), (1, 1, 4), (2, 1, 1), (3, 1, 1)], "k int, d int, o int")
    stored = spark.createDataFrame([(2, 1)], "k int, d int")
    new = merge.absent_facts(batch, stored, keys, ["o"])
    assert sorted(tuple(r) for r in new.collect()) == [(1, 1, 4), (3, 1, 1)]
    after = new.select(*keys).unionByName(stored)
    assert merge.absent_facts(batch, after, keys, ["o"]).isEmpty()


def test_quality(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4), ("b", None)], "c string, x int")
    assert quality.duplicate_summary(df, ["c"]).first().asDict() == {
        "n_rows": 5, "n_keys": 3, "n_duplicated_keys": 2, "n_surplus_rows": 2,
    }
    cities = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "n string")
    report = {r.metric: r.n_rows for r in quality.coverage_report(df, "c", ["c", "x"], cities, "n").collect()}
    assert report == {
        "rows": 5, "cities_present": 2, "cities_expected": 4, "cities_expected_distinct": 2,
        "missing_c": 2, "missing_x": 1,
    }
    none = {r.metric: r.n_rows for r in quality.coverage_report(df.limit(0), "c", ["x"], cities, "n").collect()}
    assert (none["rows"], none["cities_present"], none["missing_x"]) == (0, 0, 0)
    with pytest.raises(ValueError, match="empty"):
        require_rows(df.limit(0), "empty")
    with pytest.raises(ValueError, match="unknown"):
        require_no_rows(merge.orphans(df, "c", cities, "n"), "unknown")


def test_costly_values_are_computed_once_per_row(spark, tmp_path):
    spark.range(5).select(F.lit('{"k": 3}').alias("props")).write.parquet(str(tmp_path / "p"))
    df = once(spark.read.parquet(str(tmp_path / "p")), "k", F.get_json_object("props", "$.k").cast("int"))
    text = plan(df.where("k > 1 AND k < 9 AND k % 2 = 1").select((F.col("k") * 2).alias("x")))
    assert text.count("get_json_object") == 1


def test_parents_are_distinct_below_the_join(spark):
    parents = spark.createDataFrame([(1,)] * 50 + [(2,)], "p int")
    lost = merge.orphans(spark.createDataFrame([(1,), (3,), (3,), (None,)], "k int"), "k", parents, "p")
    assert [tuple(r) for r in lost.collect()] == [(3, 2)]
    assert plan(lost).count("HashAggregate") >= 4


def test_a_city_without_scores_is_not_the_riskiest(spark):
    facts = spark.createDataFrame(
        [(1, 50, 1.0, 1.0, "moyen"), (2, None, 2.0, 2.0, None)],
        "ville_id bigint, risk_score int, temperature_max double, precipitation_sum double, risk_level string",
    )
    cities = spark.createDataFrame([(1, "B"), (2, "A")], "id bigint, city string")
    assert serving.kpis(facts, cities).first()["riskiest_city"] == "B"
    assert serving.riskiest_city(facts, cities).first()["city"] == "B"
