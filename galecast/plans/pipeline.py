"""The batch pipeline: stored API payloads -> Bronze -> Silver -> Gold -> warehouse.

Each stage reads what the previous one wrote and replaces its own run, so any stage can be repeated
after a failure.
"""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galecast.functions.coerce import na_to_null, run_time, strict_double
from galecast.functions.plausibility import violations
from galecast.functions.risk import with_categories, with_risk
from galecast.model import GOLD_SCHEMA, ORDINAL, SILVER_SCHEMA, column_names
from galecast.operators import batches, quality
from galecast.operators.flatten import flatten_forecasts
from galecast.operators.merge import enrich, unmatched_keys
from galecast.operators.ordering import keep_first_counted, require_rows, split_position
from galecast.plans import warehouse
from galecast.plans.warehouse import Lake, commit, committed_run, counted, ended, replace_run
from galecast.sources.files import (
    CITY_COLUMNS,
    city_reference,
    common_runs,
    latest_common_run,
    read_cities,
    read_forecasts,
    read_raw_cities,
    read_table,
)

log = logging.getLogger(__name__)

# Columns whose missing values are reported.
REQUIRED = ("city", "date_prevision", "latitude", "longitude", "region")


def new_run() -> str:
    """A run identifier for now, in UTC."""
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")


def store_cities(spark: SparkSession, source: str, lake: Lake, run_ts: str) -> str:
    """Keep a city list, byte for byte, under a run that must not exist yet."""
    target = f"{lake.bronze_cities}/villes_{run_ts}.csv"
    require_rows(read_raw_cities(spark, source), "the city list is empty")
    copy_file(spark, source, target)
    return target


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    """A file to a new place on any of Hadoop's file systems."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    here, there = hadoop.Path(source), hadoop.Path(target)
    if there.getFileSystem(conf).exists(there):
        raise FileExistsError(f"{target} already exists")
    hadoop.FileUtil.copy(here.getFileSystem(conf), here, there.getFileSystem(conf), there, False, False, conf)


def plan_requests(spark: SparkSession, lake: Lake, run_ts: str) -> DataFrame:
    """The run's cities with their batch number and place in the batch, in file order."""
    cities = read_cities(spark, f"{lake.bronze_cities}/*{run_ts}*").select(
        *CITY_COLUMNS, "source_split", "source_row"
    )
    return batches.with_batch(split_position(cities, "source_split", "source_row"))


def record_lines(records: DataFrame) -> DataFrame:
    """Bronze records as JSON text, with the response embedded as it was received."""
    place = F.struct(
        "city", *(strict_double(na_to_null(F.col(c))).alias(c) for c in ("lat", "lng"))
    )
    named = records.withColumn("place", F.to_json(place, {"ignoreNullFields": "false"}))
    return named.selectExpr(
        "concat(left(place, length(place) - 1), ',\"weather_raw\":',"
        " regexp_replace(weather_raw, '[\\r\\n]+', ' '), '}') AS value"
    )


def store_forecasts(
    spark: SparkSession, payloads: DataFrame, lake: Lake, run_ts: str
) -> dict[str, int]:
    """Match stored payloads (batch_no, attempt, payload) to the planned cities.

    Writes the cities of failed batches, then one record per line in city order. Both replace those of
    an earlier attempt at the run.
    """
    batched = plan_requests(spark, lake, run_ts)
    accepted = batches.accepted_responses(payloads, batches.batch_plan(batched))
    records = batches.align(batched, accepted).orderBy("position")
    target = f"{lake.bronze_forecasts}/run_ts={run_ts}"
    failed = batches.dead_letters(batched, accepted, ["city", "batch_no", "position"])
    failed, unanswered = counted(failed.orderBy("position"), failed=F.count(F.lit(1)))
    failed.write.mode("overwrite").json(f"{lake.failed_requests}/run_ts={run_ts}")
    watched, watch = counted(record_lines(records), received=F.count(F.lit(1)))
    watched.write.mode("overwrite").text(target)
    counts = {"requested": watch.get["received"] + unanswered.get["failed"], **watch.get}
    log.info("forecasts for %d of %d cities", counts["received"], counts["requested"])
    return counts


def clean(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """Silver rows from flattened forecasts and the city reference.

    Keeps the first row of each (run, city, date), then judges it: a first row that is implausible
    does not make way for a later duplicate; ``copies`` counts the rows of a key. A record that was set aside is a key of its own. City
    attributes are joined last, to the fewest rows; nothing before depends on them.
    """
    record = F.when(F.col("text").isNotNull(), F.concat_ws("#", "source_split", "source_row"))
    keys = ["run_ts", "city", "date_prevision", "_record"]
    first = keep_first_counted(rows.withColumn("_record", record), keys, ORDINAL).drop("_record")
    broken = F.when(F.col("text").isNull(), violations()).otherwise(F.array(F.lit("incomplete_record")))
    judged = first.withColumn("retrieved_at", run_time(F.col("run_ts"))).withColumn("violations", broken)
    return enrich(judged.withColumn("accepted", F.size("violations") == 0), reference, ["run_ts", "city"])


def build_silver(
    spark: SparkSession, lake: Lake, run_ts: str | None = None, whole_document: bool = False
) -> dict[str, int]:
    """Silver for one run (the latest by default): accepted and rejected rows and records set aside.

    One job reads, cleans and writes; a repeated run replaces all three. The counts are taken from what
    was written, where each kept row knows how many rows it stands for, so they are exact whatever an executor's loss
    made Spark compute twice. A run counts as cleaned only once it is committed, and one without an
    accepted row is recorded as failed, so that no later stage picks it.
    """
    run_ts = run_ts or latest_common_run(spark, lake.bronze_cities, lake.bronze_forecasts)
    cities = read_cities(spark, f"{lake.bronze_cities}/*{run_ts}*")
    records = read_forecasts(spark, f"{lake.bronze_forecasts}/*{run_ts}*", whole_document)
    silver = clean(flatten_forecasts(records), city_reference(cities)).select(*column_names(SILVER_SCHEMA))
    replace_run(silver, lake.silver)
    counts = silver_counts(spark, lake, run_ts)
    if counts["accepted"] == 0:
        commit(spark, lake, "silver", run_ts, counts, reason="the Silver table is empty")
        raise ValueError("the Silver table is empty")
    for name in ("broken", "duplicates", "rejected"):
        if counts[name]:
            log.warning("run %s: %d %s", run_ts, counts[name], name)
    commit(spark, lake, "silver", run_ts, counts)
    return counts


def silver_counts(spark: SparkSession, lake: Lake, run_ts: str) -> dict[str, int]:
    """Rows flattened, accepted, rejected and repeated, and records set aside, of a run as it is stored."""
    stored = read_table(spark, lake.silver, SILVER_SCHEMA, run_ts)
    counts = quality.stage_totals(stored.where("text IS NULL")).first().asDict()
    counts["duplicates"] = counts["flattened"] - counts.pop("deduplicated")
    return {"broken": stored.where("text IS NOT NULL").count(), **counts}


def set_aside(spark: SparkSession, lake: Lake, run_ts: str) -> DataFrame:
    """The records of a run without complete days, with their text as received."""
    stored = read_table(spark, lake.silver, SILVER_SCHEMA, run_ts).where("text IS NOT NULL")
    return stored.select("city", "text", "source_split", "source_row", "run_ts")


def read_silver(spark: SparkSession, lake: Lake, run_ts: str) -> DataFrame:
    """The accepted rows of a run."""
    return read_table(spark, lake.silver, SILVER_SCHEMA, run_ts).where("accepted").drop("accepted", "violations", "text", "copies")


def silver_report(spark: SparkSession, lake: Lake, run_ts: str) -> DataFrame:
    """Coverage and missing values of a run's accepted rows; also logs what is amiss."""
    silver = read_silver(spark, lake, run_ts)
    cities = read_cities(spark, f"{lake.bronze_cities}/*{run_ts}*")
    report = quality.coverage_report(silver, "city", REQUIRED, cities, "city")
    figures = {row["metric"]: row["n_rows"] for row in report.collect()}
    if figures["cities_present"] < figures["cities_expected"]:
        log.warning("%d of %d cities present", figures["cities_present"], figures["cities_expected"])
    repeated = figures["cities_expected"] - figures["cities_expected_distinct"]
    if repeated:
        log.warning("%d repeated or unnamed cities in the list; the first of a name counts", repeated)
    unmatched = cities_without_region(spark, lake, run_ts).count()
    if unmatched:
        log.warning("%d cities without a region", unmatched)
    for column in REQUIRED:
        if figures[f"missing_{column}"]:
            log.warning("%d missing values in %s", figures[f"missing_{column}"], column)
    return report


def cities_without_region(spark: SparkSession, lake: Lake, run_ts: str) -> DataFrame:
    return unmatched_keys(read_silver(spark, lake, run_ts), "city", "region")


def build_gold(spark: SparkSession, lake: Lake, run_ts: str | None = None) -> int:
    """Categories, score and level for one committed run of Silver; a narrow job."""
    run_ts = committed_run(spark, lake, "silver", run_ts)
    scored = with_risk(with_categories(read_silver(spark, lake, run_ts)))
    watched, watch = counted(scored.select(*column_names(GOLD_SCHEMA)), rows=F.count(F.lit(1)))
    replace_run(watched, lake.gold)
    commit(spark, lake, "gold", run_ts, watch.get)
    return watch.get["rows"]


def load_warehouse(spark: SparkSession, lake: Lake, run_ts: str | None = None) -> dict[str, int]:
    """Upsert the cities, insert the forecasts that are not stored yet, and bring their latest versions and states up to date.

    Every Gold row is inserted, stored already, or rejected with its reason; a city that cannot be
    found is an error. What the load wrote shows with its entry in the ledger, the last step; a load that fails shows
    nothing, and its repeat writes everything anew.
    """
    run_ts = committed_run(spark, lake, "gold", run_ts)
    gold = read_table(spark, lake.gold, GOLD_SCHEMA, run_ts)
    load, known = warehouse.begin(spark, lake), warehouse.contents(spark, lake)
    rejected = warehouse.write_rejects(lake, gold, run_ts)
    parts, last_id = warehouse.load_cities(spark, lake, gold, known, load)
    cities = warehouse.current_cities(spark, lake, known.with_load(load, [], parts))
    dates = warehouse.load_facts(spark, lake, gold, cities, run_ts, known, load)
    inserted = warehouse.count_facts(spark, lake, load, dates)
    counts = {"inserted": inserted, "rejected": rejected, "stored_before": gold.count() - inserted - rejected}
    if counts["stored_before"] < 0 or warehouse.missing_facts(spark, lake, gold, cities, run_ts, known.with_load(load, dates, parts)):
        raise ValueError(f"run {run_ts}: forecasts were lost on the way to the warehouse")
    months = warehouse.refresh_latest(spark, lake, known, load, dates)
    warehouse.finish(spark, lake, load, "load", run_ts, dates, parts, last_id, months)
    commit(spark, lake, "load", run_ts, counts)
    log.info("run %s: %d forecasts inserted, %d rejected", run_ts, inserted, rejected)
    return counts


def run_all(
    spark: SparkSession, lake: Lake, run_ts: str | None = None, whole_document: bool = False
) -> dict[str, int]:
    """Silver, Gold and load for one Bronze run."""
    run_ts = run_ts or latest_common_run(spark, lake.bronze_cities, lake.bronze_forecasts)
    counts = build_silver(spark, lake, run_ts, whole_document)
    silver_report(spark, lake, run_ts)
    counts["gold"] = build_gold(spark, lake, run_ts)
    return counts | load_warehouse(spark, lake, run_ts)


def run_pending(spark: SparkSession, lake: Lake, whole_document: bool = False) -> dict[str, dict[str, int]]:
    """Every Bronze run that is not loaded yet, oldest first, from the first stage it lacks.

    A run that turns out empty is recorded as failed and left; the others go on.
    """
    done, failed = ended(spark, lake), ended(spark, lake, "failed").get("silver", set())
    results = {}
    for run_ts in common_runs(spark, lake.bronze_cities, lake.bronze_forecasts):
        if run_ts in done.get("load", set()) | failed:
            continue
        if run_ts in done.get("gold", set()):
            results[run_ts] = load_warehouse(spark, lake, run_ts)
            continue
        try:
            results[run_ts] = run_all(spark, lake, run_ts, whole_document)
        except ValueError as error:
            if run_ts not in ended(spark, lake, "failed").get("silver", set()):
                raise
            log.warning("run %s: %s", run_ts, error)
    return results
