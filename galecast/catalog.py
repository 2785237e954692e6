"""Every registered query over the driver's tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galecast.functions import plausibility, risk
from galecast.functions.coerce import (
    fits,
    once,
    run_in,
    run_of,
    run_time,
    store_as,
    strict_date,
    strict_double,
)
from galecast.model import FilterSpec
from galecast.operators import batches, merge, quality
from galecast.operators.flatten import explode_arrays, flatten_forecasts
from galecast.operators.ordering import keep_first, key_position, latest_run_rows, latest_versions
from galecast.plans import analytics, current, pipeline, serving, states, warehouse
from galecast.sources.driver_tables import (
    VERSION,
    batched_customers,
    cities,
    cities_with_region,
    forecast_arrays,
    forecast_documents,
    forecast_keys,
    forecasts,
    table,
    weather,
    with_prop_k,
)
from galecast.sources.files import parse_records
from galecast.sources.ranges import read_array_records
from galecast.sources.scratch import scratch

Query = Callable[[SparkSession, str], DataFrame]

KEY = ("ville_id", "date_prevision")
LINE_KEY = ("l_orderkey", "l_linenumber")


def _current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.latest(forecasts(spark, sf_dir), VERSION)


def _selected(spark: SparkSession, sf_dir: str, spec: FilterSpec, region: str | None = None) -> DataFrame:
    """Forecasts under a dashboard selection; the cities of one region stand for the picked names."""
    places = cities_with_region(spark, sf_dir)
    names = places.where(F.col("region") == region) if region else None
    return serving.select_forecasts(
        forecasts(spark, sf_dir), cities(spark, sf_dir), spec, VERSION, names
    )


# ---- analytics questions -------------------------------------------------------------------


def q1_max_temp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.hottest_cities(_current(spark, sf_dir), cities(spark, sf_dir))


def q2_max_precip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.wettest_cities(_current(spark, sf_dir), cities(spark, sf_dir))


def q3_avg_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.riskiest_cities(_current(spark, sf_dir), cities(spark, sf_dir))


def q4_risk_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.risk_by_day(_current(spark, sf_dir))


def q5_worst_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.worst_day_by_city(_current(spark, sf_dir), cities(spark, sf_dir))


def q6_above_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.cities_above_average(_current(spark, sf_dir), cities(spark, sf_dir))


# ---- versions, scoring, cleaning -----------------------------------------------------------


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_versions(forecast_keys(spark, sf_dir), KEY, VERSION)


def latest_version_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest versions as a stored table keeps them: three loads, each of them older and newer than the others in places."""
    events, path = forecast_keys(spark, sf_dir), scratch(spark, "latest")
    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in events.schema)
    held: dict[date, int] = {}
    for load, part in enumerate((1, 2, 0)):
        rows = events.where(F.col("event_id") % 3 == part)
        held = current.merge_latest(spark, path, schema, rows, held, load, KEY, VERSION)
    return current.read_days(spark, path, schema, "date_prevision", held.items())


def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last run; a run is a day of events here."""
    day = F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")
    events = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("ville_id"), run_of(day).alias("run_ts"))
    return latest_run_rows(events)


def risk_subscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plausibility.plausible(weather(spark, sf_dir))
    return risk.with_subscores(rows).select(
        "event_id", "temperature_risk", "precipitation_risk", "wind_risk"
    )


def risk_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecasts(spark, sf_dir).select("event_id", "risk_score", "risk_level")


def weather_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plausibility.plausible(weather(spark, sf_dir))
    counted = risk.with_categories(rows).groupBy(
        "temperature_category", "precipitation_category", "wind_category"
    )
    return counted.agg(F.count(F.lit(1)).alias("n_rows"))


def risk_level_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.level_distribution(forecasts(spark, sf_dir))


def plausibility_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plausibility.plausible(weather(spark, sf_dir)).select("event_id", *KEY)


def plausibility_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plausibility.reject_counts(weather(spark, sf_dir))


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = weather(spark, sf_dir).withColumn("violations", plausibility.violations())
    return rows.where(F.size("violations") > 0).select(
        "event_id", F.array_join("violations", ",").alias("violations")
    )


def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.withColumns({c: F.col(c) + F.lit(0.0) for c in ("l_discount", "l_tax")})
    return keep_first(lines, LINE_KEY, [c for c in lines.columns if c not in LINE_KEY])


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning in full order: keep-first per city and day, then plausibility, categories, score."""
    first = keep_first(weather(spark, sf_dir), KEY, ["event_id"])
    scored = risk.with_risk(risk.with_categories(plausibility.plausible(first)))
    return scored.select(
        "event_id", *KEY, "temperature_category", "precipitation_category", "wind_category",
        "risk_score", "risk_level",
    )


def coerce_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and dates in eight and four spellings, some of which are no number or date."""
    spelt = with_prop_k(table(spark, sf_dir, "events")).selectExpr(
        "event_id",
        """CASE event_id % 8 WHEN 0 THEN concat(' ', k, ' ') WHEN 1 THEN concat(k, 'e2')
                WHEN 2 THEN concat('abc', k) WHEN 3 THEN concat(k, 'd') WHEN 4 THEN concat('0x', k)
                WHEN 5 THEN concat(k, '_000') WHEN 6 THEN '' ELSE concat('-', k, '.5') END AS number""",
        """CASE event_id % 4 WHEN 0 THEN date_format(ts, 'yyyy-MM-dd')
                WHEN 1 THEN concat(date_format(ts, 'yyyy-MM-dd'), 'T05:00')
                WHEN 2 THEN date_format(ts, 'dd/MM/yyyy')
                ELSE concat(date_format(ts, 'yyyy'), '-02-30') END AS day""",
    )
    return once(spelt, "text", F.col("number")).select(
        "event_id", strict_double(F.col("text")).alias("number"), strict_date(F.col("day")).alias("day")
    )


def json_extract_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("props", "k int")
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("weather_code"))


def _cleaned(spark: SparkSession, sf_dir: str, records: DataFrame) -> DataFrame:
    """Forecast records through the reader's parsing, flattening and cleaning, with the verdict on each row."""
    places = cities_with_region(spark, sf_dir).selectExpr("'20240101_000000' AS run_ts", "CAST(id AS STRING) AS city", "region", "latitude AS population")
    rows = pipeline.clean(flatten_forecasts(parse_records(records)), places)
    return rows.where("text IS NULL").select(
        "city", "date_prevision", "temperature_max", "temperature_min", "precipitation_sum", "wind_gusts_max", "weather_code",
        F.coalesce("region", F.lit("-")).alias("region"), "accepted", F.array_join("violations", ",").alias("violations"),
    )


def documents_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record a line."""
    return _cleaned(spark, sf_dir, forecast_documents(spark, sf_dir))


def documents_array_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from files that hold one array each, cut into byte ranges."""
    return _cleaned(spark, sf_dir, read_array_records(spark, forecast_arrays(spark, sf_dir)))


def documents_set_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records without complete days, with their text as received."""
    records = flatten_forecasts(parse_records(forecast_documents(spark, sf_dir)))
    return records.where("text IS NOT NULL").select(
        F.col("source_row").alias("user_id"), "source_split", "text"
    )


def flatten_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    component = F.col("embedding")
    rows = explode_arrays(vectors, component, {"component": component}, "vec_id", "label")
    return rows.select("vec_id", "label", "day_index", F.col("component").cast("double").alias("component"))


# ---- batches -------------------------------------------------------------------------------


def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.batch_plan(batched_customers(spark, sf_dir))


def batch_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.batch_params(batched_customers(spark, sf_dir), "latitude", "longitude")


def envelope_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of one object, a list of one, a list of two, and one that is cut off."""
    payload = F.expr(
        """CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN concat('[', props, ']')
                WHEN 2 THEN concat(' [', props, ', ', props, '] ') ELSE concat('[', props) END"""
    )
    events = once(table(spark, sf_dir, "events"), "responses", batches.envelope(payload))
    return events.selectExpr(
        "event_id",
        "CAST(coalesce(size(responses), -1) AS INT) AS n_responses",
        "coalesce(CAST(get_json_object(get(responses, 0), '$.k') AS INT), -1) AS first_k",
    )


def _received(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("id"))


def batch_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.validate_batches(batched_customers(spark, sf_dir), _received(spark, sf_dir), "id")


def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched = batched_customers(spark, sf_dir)
    checked = batches.validate_batches(batched, _received(spark, sf_dir), "id")
    return batches.dead_letters(batched, checked.where("ok"), ["city", "batch_no"])


def positional_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The k-th customer of a batch with the k-th supplier of that batch."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    responses = batches.with_batch(key_position(suppliers, "s_suppkey"))
    joined = batches.positional_join(
        batched_customers(spark, sf_dir).select("batch_no", "pos", "city"),
        responses.select("batch_no", "pos", "s_name"),
    )
    return joined.select("batch_no", "pos", "city", "s_name")


# ---- quality -------------------------------------------------------------------------------


def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_summary(table(spark, sf_dir, "lineitem"), LINE_KEY)


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicated_keys(table(spark, sf_dir, "lineitem"), LINE_KEY)


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plausibility.plausible(weather(spark, sf_dir))
    required = (*KEY, "temperature_max", "precipitation_sum")
    return quality.coverage_report(
        rows, "ville_id", required, table(spark, sf_dir, "customer"), "c_custkey"
    )


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = weather(spark, sf_dir)
    return quality.missing_counts(rows, (*KEY, "retrieved_at", "temperature_max", "precipitation_sum"))


def dq_text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text beyond the widths of the warehouse's columns."""
    return quality.overlong_counts(table(spark, sf_dir, "documents"), {"text": 150, "lang": 20, "source": 20})


def dq_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.stage_counts(weather(spark, sf_dir), KEY, ["event_id"], plausibility.is_plausible())


def dq_referential(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and keys without a parent, per relationship."""
    relations = (
        ("orders-customer", "orders", "o_custkey", "customer", "c_custkey"),
        ("events-customer", "events", "user_id", "customer", "c_custkey"),
        ("customer-events", "customer", "c_custkey", "events", "user_id"),
        ("documents-labels", "documents", "doc_id", "labels", "doc_id"),
    )
    report = None
    for name, child, child_key, parent, parent_key in relations:
        lost = merge.orphans(
            table(spark, sf_dir, child), child_key, table(spark, sf_dir, parent), parent_key
        )
        line = lost.agg(
            F.lit(name).alias("relation"),
            F.count(F.lit(1)).alias("n_keys"),
            F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"),
        )
        report = line if report is None else report.unionByName(line)
    return report


# ---- joins and merges ----------------------------------------------------------------------


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return merge.enrich(documents, table(spark, sf_dir, "labels"), ["doc_id"])


def enrich_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its labels; -1 where it has none."""
    shown = {c: F.coalesce(F.col(c), F.lit(-1)) for c in ("quality", "toxic")}
    return _labelled(spark, sf_dir).withColumns(shown)


def unmatched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.unmatched_keys(_labelled(spark, sf_dir), "doc_id", "quality")


def surrogate_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that know their customer by name only, given the customer's id."""
    named = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("city"),
    )
    return merge.attach_ids(named, cities(spark, sf_dir), how="inner").select("o_orderkey", "ville_id")


def dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension knows every region but ASIA; then all cities with forecasts are sent.

    Sent attributes differ from the stored ones, and the sent region is missing for cities placed at
    a negative latitude.
    """
    places = cities_with_region(spark, sf_dir)
    existing = places.where(F.col("region") != "ASIA")
    seen = table(spark, sf_dir, "events").select(F.col("user_id").alias("id")).distinct()
    incoming = places.join(seen, "id", "left_semi").select(
        "id",
        "city",
        (F.col("latitude") + 1).alias("latitude"),
        "longitude",
        F.when(F.col("latitude") >= 0, F.col("region")).alias("region"),
    )
    merged = merge.upsert_cities(existing, incoming, lambda new: key_position(new, "id"))
    return merged.withColumn("region", F.coalesce("region", F.lit("-")))


def dim_upsert_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge over a dimension stored in parts, of which the second load writes those that change; kept ids are told."""
    lake = warehouse.Lake(scratch(spark, "villes"))
    places = cities_with_region(spark, sf_dir).withColumns({c: F.floor(F.col(c) / n).cast("decimal(9,6)") for c, n in (("latitude", 128), ("longitude", 1))})
    seen = table(spark, sf_dir, "events").select(F.col("user_id").alias("id")).distinct()
    first = places.where(F.col("region") != "ASIA")
    second = places.join(seen, "id", "left_semi").withColumns(
        {"latitude": (F.col("latitude") + 1).cast("decimal(9,6)"), "region": F.when(F.col("latitude") >= 0, F.col("region"))}
    )
    known, before = warehouse.Contents({}, {}, {}, 0), None
    for load, sent in enumerate((first, second), start=1):
        before = warehouse.current_cities(spark, lake, known)
        rows = sent.select("id", "city", "latitude", "longitude", "region", F.lit(f"{load}").alias("updated_by"), warehouse.city_part(F.col("city")).alias("part"))
        parts, last_id = warehouse.merge_cities(spark, lake, rows, known, load, lambda new: key_position(new, "id"))
        known = known.with_load(load, [], parts)._replace(last_id=last_id)
    old = before.select("city", F.col("id").alias("old_id"))
    return warehouse.current_cities(spark, lake, known).join(old, "city", "left").select(
        "city", *(F.col(c).cast("double").alias(c) for c in ("latitude", "longitude")), F.coalesce("region", F.lit("-")).alias("region"),
        F.coalesce(F.col("old_id") == F.col("id"), F.lit(False)).alias("kept"),
    )


def fact_insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All event types but sign-ups are stored; then the whole feed is sent again."""
    feed = forecast_keys(spark, sf_dir)
    stored = table(spark, sf_dir, "events").where(F.col("event_type") != "signup")
    stored = stored.selectExpr("user_id AS ville_id", "CAST(ts AS DATE) AS date_prevision", "ts AS retrieved_at")
    return merge.absent_facts(feed, stored, (*KEY, "retrieved_at"), ["event_id"])


def numeric_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices at warehouse precision; what does not fit is flagged and stays empty."""
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        F.coalesce(store_as("l_extendedprice", "decimal(6,2)").cast("string"), F.lit("")).alias("price"),
        store_as("l_quantity", "decimal(5,2)").cast("string").alias("quantity"),
        fits("l_extendedprice", "decimal(6,2)").alias("fits"),
    )


def run_ts_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = run_of(F.col("ts"))
    name = F.concat(F.lit("bronze/meteo/meteo_"), run, F.lit(".json"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        run.alias("run_ts"),
        run_time(run).alias("retrieved_at"),
        run_in(name).alias("run_in_name"),
        F.to_date(run_time(run)).alias("run_date"),
    )


# ---- dashboard -----------------------------------------------------------------------------


def serving_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.serving_view(_current(spark, sf_dir), cities(spark, sf_dir))


def dash_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.filter_options(forecasts(spark, sf_dir), cities(spark, sf_dir))


def _view(current: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.detail(current, cities(spark, sf_dir)).select(
        "city", "date_prevision", "risk_score", "risk_level"
    )


def dash_filter_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(_selected(spark, sf_dir, FilterSpec(), "EUROPE"), spark, sf_dir)


def dash_filter_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(_selected(spark, sf_dir, FilterSpec(period_days=3), "AFRICA"), spark, sf_dir)


def dash_filter_combo(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = FilterSpec(period_days=7, dates=("2024-01-02", "2024-01-05"), levels=("moyen", "élevé"))
    return _view(_selected(spark, sf_dir, spec, "EUROPE"), spark, sf_dir)


def dash_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.kpis(_current(spark, sf_dir), cities(spark, sf_dir))


def dash_kpi_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = _selected(spark, sf_dir, FilterSpec(period_days=7))
    return serving.kpi_labels(serving.kpis(week, cities(spark, sf_dir)))


def dash_top_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.riskiest_city(_current(spark, sf_dir), cities(spark, sf_dir))


def dash_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.map_rows(_current(spark, sf_dir), cities(spark, sf_dir))


def dash_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.top_cities(_current(spark, sf_dir), cities(spark, sf_dir))


def dash_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.detail(_current(spark, sf_dir), cities(spark, sf_dir))


# ---- the same from stored states -------------------------------------------------------------

STATE_COLUMNS = ("event_id", *KEY, "retrieved_at", "temperature_max", "precipitation_sum", "risk_score", "risk_level")


def _figures(spark: SparkSession, sf_dir: str) -> states.Figures:
    """Latest versions and their states as three loads leave them, each of them older and newer than the others in places."""
    rows = forecasts(spark, sf_dir).select(*STATE_COLUMNS)
    path, schema = scratch(spark, "figures"), ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in rows.schema)
    held: dict[date, int] = {}
    known: dict[date, int] = {}
    for load, part in enumerate((1, 2, 0)):
        held = current.merge_latest(spark, f"{path}/derniers", schema, rows.where(F.col("event_id") % 3 == part), held, load, KEY, VERSION)
        months = states.months_of(day for day, at in held.items() if at == load)
        latest = current.read_days(spark, f"{path}/derniers", schema, KEY[1], [(day, at) for day, at in held.items() if day.replace(day=1) in months])
        known = states.merge_states(path, latest, months, known, load)
    by_city, by_day = states.read_states(spark, path, known, states.city_schema("double", "double"))
    return states.Figures(by_city, by_day, current.read_days(spark, f"{path}/derniers", schema, KEY[1], held.items()), held, known)


def _region(spark: SparkSession, sf_dir: str, region: str) -> DataFrame:
    return cities_with_region(spark, sf_dir).where(F.col("region") == region)


def dash_kpis_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A period of seven days, which cuts a month, of one region's cities."""
    chosen = _figures(spark, sf_dir).select(cities(spark, sf_dir), FilterSpec(period_days=7), _region(spark, sf_dir, "EUROPE"))
    return serving.kpi_totals(states.city_means(chosen), cities(spark, sf_dir))


def dash_top10_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dates, so whole months only, of the two upper levels."""
    chosen = _figures(spark, sf_dir).select(cities(spark, sf_dir), FilterSpec(levels=("moyen", "élevé")))
    return states.PANELS["top"](chosen, cities(spark, sf_dir))


def q4_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.QUESTIONS["q4"](_figures(spark, sf_dir), cities(spark, sf_dir))


def q5_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.QUESTIONS["q5"](_figures(spark, sf_dir), cities(spark, sf_dir))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        q1_max_temp, q2_max_precip, q3_avg_risk, q4_risk_by_day, q5_worst_day, q6_above_average,
        latest_version, latest_version_incremental, latest_run, risk_subscores, risk_score, weather_categories,
        risk_level_distribution, plausibility_filter, plausibility_reject, reject_reasons,
        dedup_first, silver_rows, coerce_types, json_extract_measures, documents_clean, documents_array_split, documents_set_aside, flatten_arrays,
        batch_plan, batch_params, envelope_normalise, batch_validation, dead_letter, positional_join,
        dq_duplicates, dq_unique, dq_report, dq_not_null, dq_text_length, dq_stage_counts,
        dq_referential, enrich_left_join, unmatched_keys, surrogate_lookup, dim_upsert, dim_upsert_parts,
        fact_insert_absent, numeric_cast, run_ts_roundtrip, serving_view, dash_options,
        dash_filter_city, dash_filter_period, dash_filter_combo, dash_kpis, dash_kpi_labels,
        dash_top_city, dash_map, dash_top10, dash_detail, dash_kpis_states, dash_top10_states, q4_states, q5_states,
    )
}
