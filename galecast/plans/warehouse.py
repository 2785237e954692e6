"""Table layout and the writes of each stage.

Silver and Gold are Parquet partitioned by run; a stage that is run again replaces its run's
partition when the job commits. A small table says which stages ended for which run.

The warehouse is written by loads, numbered from 1, a number for each attempt. Facts and their latest versions lie by target date and load, states of
the latest versions by month and load, the city dimension by part (hash of the name) and load. A load writes new folders only and records them in the ledger as its
last step; readers open the folders that the ledger names, so a load that fails or has not ended shows nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from galecast.functions.coerce import fits, store_as
from galecast.model import (
    RUNS_SCHEMA,
    CITY_PRECISION,
    CITY_SCHEMA,
    CITY_TEXT_LIMITS,
    FACT_KEY,
    FACT_PRECISION,
    FACT_SCHEMA,
    FACT_TEXT_LIMITS,
    LEDGER_SCHEMA,
    ORDINAL,
)
from galecast.operators.merge import CITY_ATTRIBUTES, absent_facts, attach_ids, changing, orphans, upsert_cities
from galecast.operators.ordering import keep_first, latest_run_rows, split_position
from galecast.operators.quality import duplicated_keys, missing_counts, overlong_counts
from galecast.plans import states
from galecast.plans.current import merge_latest, read_days, write_days, written_days
from galecast.sources.files import names_in, read_folders, read_table

# Parts of the city dimension; a load reads and writes those its cities fall into.
CITY_PARTS = 16
# Loads a date may consist of before its files are merged.
MOST_LOADS = 7
DAY = "date_prevision"


class Lake:
    """Where each table lives below one root."""

    def __init__(self, root: str):
        self.bronze_cities = f"{root}/bronze/villes"
        self.bronze_forecasts = f"{root}/bronze/meteo"
        self.failed_requests = f"{root}/echec/extract"
        self.silver = f"{root}/silver"
        self.gold = f"{root}/gold"
        self.cities = f"{root}/entrepot/villes"
        self.facts = f"{root}/entrepot/previsions"
        self.latest = f"{root}/entrepot/derniers"
        self.states = f"{root}/entrepot/etats"
        self.ledger = f"{root}/entrepot/journal"
        self.begun = f"{root}/entrepot/commences"
        self.rejects = f"{root}/entrepot/rejets"
        self.runs = f"{root}/runs"


def commit(spark: SparkSession, lake: Lake, stage: str, run_ts: str, counts: dict[str, int], reason: str = "") -> None:
    """Record, after everything else of a stage is written, that it ended for a run."""
    outcome = "failed" if reason else "done"
    row = spark.createDataFrame([(outcome, reason, counts)], "outcome string, reason string, counts map<string,bigint>")
    row.coalesce(1).write.mode("overwrite").parquet(f"{lake.runs}/stage={stage}/run_ts={run_ts}")


def ended(spark: SparkSession, lake: Lake, outcome: str = "done") -> dict[str, set[str]]:
    """The runs of each stage that ended so: one row per stage and run, not the files of the tables."""
    found: dict[str, set[str]] = {}
    for row in read_table(spark, lake.runs, RUNS_SCHEMA).where(F.col("outcome") == outcome).select("stage", "run_ts").collect():
        found.setdefault(row["stage"], set()).add(row["run_ts"])
    return found


def committed_run(spark: SparkSession, lake: Lake, stage: str, run_ts: str | None = None) -> str:
    """The given run, or the latest, if the stage ended for it; an error otherwise."""
    runs = read_table(spark, lake.runs, RUNS_SCHEMA).where((F.col("outcome") == "done") & (F.col("stage") == stage))
    found = (runs.where(F.col("run_ts") == run_ts) if run_ts else latest_run_rows(runs)).first()
    if found is None:
        raise FileNotFoundError(f"{stage} holds no run {run_ts or ''}".rstrip())
    return found["run_ts"]


def replace_run(df: DataFrame, path: str) -> None:
    """Write the runs in ``df``, replacing those partitions and no others."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_ts").parquet(path)


def replace_audit(df: DataFrame, path: str, run_ts: str) -> None:
    """Write rows set aside in a run; none at all also replaces those of an earlier attempt."""
    df.drop("run_ts").write.mode("overwrite").parquet(f"{path}/run_ts={run_ts}")


def counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """The same rows with counters that are filled by the action that writes them."""
    watch = Observation()
    return df.observe(watch, *(c.cast("bigint").alias(n) for n, c in counts.items())), watch


def _tests(required: list[str], kinds: dict[str, str], limits: dict[str, int]) -> list[tuple[str, Column]]:
    """Column name and the condition under which its value cannot be loaded; never NULL."""
    tests = [(c, F.col(c).isNull()) for c in required]
    tests += [(c, ~fits(c, kind)) for c, kind in kinds.items()]
    return tests + [(c, F.coalesce(F.length(c) > n, F.lit(False))) for c, n in limits.items()]


def _city_tests() -> list[tuple[str, Column]]:
    return _tests(["city", "latitude", "longitude"], CITY_PRECISION, CITY_TEXT_LIMITS)


def _fact_tests() -> list[tuple[str, Column]]:
    return _tests(["date_prevision", "retrieved_at"], FACT_PRECISION, FACT_TEXT_LIMITS)


def _passes(tests: list[tuple[str, Column]]) -> Column:
    return reduce(and_, (~failed for _, failed in tests))


def problems() -> Column:
    """Names of the columns a row cannot be loaded for."""
    blamed = (F.when(failed, F.lit(name)) for name, failed in _city_tests() + _fact_tests())
    return F.array_distinct(F.array_compact(F.array(*blamed)))


class Contents(NamedTuple):
    """What the ended loads left: the loads that make up each date, the one that holds its latest versions, the one that holds each part of
    the dimension, the last city id given, and the load that holds the states of each month."""

    dates: dict[date, list[int]]
    latest: dict[date, int]
    parts: dict[int, int]
    last_id: int
    months: dict[date, int] = {}

    def with_load(self, load: int, dates: Iterable[date], parts: Iterable[int]) -> Contents:
        """The same with a load that has not ended."""
        merged = {day: [*self.dates.get(day, []), load] for day in dates}
        return self._replace(dates=self.dates | merged, parts=self.parts | dict.fromkeys(parts, load))


def contents(spark: SparkSession, lake: Lake) -> Contents:
    """From the ledger, which has one row a load."""
    out = Contents({}, {}, {}, 0, {})
    for row in sorted(read_table(spark, lake.ledger, LEDGER_SCHEMA).collect(), key=lambda row: row["load"]):
        load = row["load"]
        for day in row["dates"]:
            if row["kind"] == "merge":
                out.dates[day] = [load, *(other for other in out.dates[day] if other > load)]
            else:
                out.dates.setdefault(day, []).append(load)
                out.latest[day] = load
        out.months.update(dict.fromkeys(row["months"] or (), load))
        out = out._replace(parts=out.parts | dict.fromkeys(row["parts"], load), last_id=max(out.last_id, row["last_id"]))
    return out


def begin(spark: SparkSession, lake: Lake) -> int:
    """A number that no load, ended or not, has had."""
    load = 1 + max((int(name.removeprefix("load=")) for name in names_in(spark, lake.begun)), default=0)
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{lake.begun}/load={load}")
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).create(mark, False).close()
    return load


def finish(
    spark: SparkSession, lake: Lake, load: int, kind: str, run_ts: str, dates: Iterable[date], parts: Iterable[int], last_id: int,
    months: Iterable[date] = (),
) -> None:
    """Show what a load wrote."""
    row = spark.createDataFrame([(kind, run_ts, list(dates), list(parts), last_id, list(months))], ", ".join(LEDGER_SCHEMA.split(", ")[:-1]))
    row.coalesce(1).write.mode("overwrite").parquet(f"{lake.ledger}/load={load}")


def _cities(spark: SparkSession, lake: Lake, parts: dict[int, int]) -> DataFrame:
    found = [f"{lake.cities}/part={part}/load={load}" for part, load in sorted(parts.items())]
    return read_folders(spark, lake.cities, f"{CITY_SCHEMA}, part int, load int", found).drop("load")


def current_cities(spark: SparkSession, lake: Lake, known: Contents | None = None) -> DataFrame:
    """The dimension; empty before the first load."""
    return _cities(spark, lake, (known or contents(spark, lake)).parts).drop("part")


def facts(spark: SparkSession, lake: Lake, known: Contents | None = None, days: Iterable[date] | None = None) -> DataFrame:
    """All forecast versions ever loaded, or those of some dates."""
    dates = (known or contents(spark, lake)).dates
    wanted = dates if days is None else [day for day in days if day in dates]
    return read_days(spark, lake.facts, FACT_SCHEMA, DAY, [(day, load) for day in wanted for load in dates[day]])


def latest_facts(spark: SparkSession, lake: Lake, known: Contents | None = None) -> DataFrame:
    """The latest version of every city and date, as the loads keep it; reads no older version."""
    return read_days(spark, lake.latest, FACT_SCHEMA, DAY, (known or contents(spark, lake)).latest.items())


def load_cities(spark: SparkSession, lake: Lake, gold: DataFrame, known: Contents, load: int) -> tuple[list[int], int]:
    """Upsert the cities of loadable Gold rows; the parts written and the last id given.

    The first row of a city, in source order, carries its attributes, unless a later run has set
    them already; new cities are numbered in source order. Only parts that change are written, and only parts that the
    cities fall into are read.
    """
    usable = gold.where(_passes(_city_tests())).select(
        "city",
        *(store_as(c, kind).alias(c) for c, kind in CITY_PRECISION.items()),
        "region",
        F.col("run_ts").alias("updated_by"),
        *ORDINAL,
    )
    incoming = keep_first(usable, ["city"], ORDINAL).withColumn("part", city_part(F.col("city")))
    return merge_cities(spark, lake, incoming, known, load, lambda new: split_position(new, "source_split", "source_row"))


def city_part(city: Column) -> Column:
    return F.pmod(F.xxhash64(city), F.lit(CITY_PARTS)).cast("int")


def merge_cities(
    spark: SparkSession, lake: Lake, incoming: DataFrame, known: Contents, load: int, number: Callable[[DataFrame], DataFrame]
) -> tuple[list[int], int]:
    """Upsert cities that know their part into the dimension's parts; see load_cities."""

    def parts_of(df: DataFrame) -> list[int]:
        return sorted(row["part"] for row in df.select("part").distinct().collect())

    near = {part: known.parts[part] for part in parts_of(incoming) if part in known.parts}
    touched = parts_of(changing(_cities(spark, lake, near).drop("part"), incoming, "city", CITY_ATTRIBUTES, "updated_by"))
    if not touched:
        return [], known.last_id
    existing = _cities(spark, lake, {part: at for part, at in near.items() if part in touched}).drop("part")
    here = incoming.where(F.col("part").isin(touched))
    merged = upsert_cities(existing, here, number, version="updated_by", last_id=known.last_id)
    placed = merged.withColumns({"part": city_part(F.col("city")), "load": F.lit(load)}).repartition("part")
    placed.write.mode("append").partitionBy("part", "load").parquet(lake.cities)
    written = _cities(spark, lake, dict.fromkeys(touched, load)).agg(F.max("id")).first()[0]
    return touched, max(known.last_id, written)


def load_facts(spark: SparkSession, lake: Lake, gold: DataFrame, cities: DataFrame, run_ts: str, known: Contents, load: int) -> list[date]:
    """Write the run's forecasts that are not stored yet; the dates written.

    Every loadable row must find its city: the dimension was just loaded from the same rows. The facts
    are partitioned by date and sorted by city, for questions and panels; a batch is compared with
    the facts of its own dates.
    """
    loadable = gold.where(_passes(_city_tests() + _fact_tests()))
    ided = attach_ids(loadable, cities)
    ided = ided.withColumn("ville_id", F.coalesce("ville_id", F.raise_error(F.concat(F.lit("no such city: "), F.col("city")))))
    typed = ided.select(
        "ville_id",
        "date_prevision",
        *(store_as(c, kind).alias(c) for c, kind in FACT_PRECISION.items()),
        *FACT_TEXT_LIMITS,
        "risk_score",
        "retrieved_at",
        "run_ts",
        *ORDINAL,
    )
    days = [row[0] for row in loadable.select(DAY).distinct().collect()]
    stored = facts(spark, lake, known, days).where(F.col("run_ts") == run_ts)
    new = absent_facts(typed, stored, FACT_KEY, ORDINAL).drop(*ORDINAL)
    write_days(new, lake.facts, DAY, "ville_id", load)
    return written_days(spark, lake.facts, DAY, days, load)


def figures(spark: SparkSession, lake: Lake, known: Contents | None = None) -> states.Figures:
    """The latest versions with their states, which questions and panels read instead of versions."""
    known = known or contents(spark, lake)
    by_city, by_day = states.read_states(spark, lake.states, known.months, states.city_schema())
    return states.Figures(by_city, by_day, latest_facts(spark, lake, known), known.latest, known.months)


def refresh_latest(spark: SparkSession, lake: Lake, known: Contents, load: int, dates: list[date]) -> list[date]:
    """The latest versions of the dates that a load wrote, from the stored ones and the load's own facts; then the states of their months.

    The months written.
    """
    own = read_days(spark, lake.facts, FACT_SCHEMA, DAY, [(day, load) for day in dates])
    held = merge_latest(spark, lake.latest, FACT_SCHEMA, own, known.latest, load)
    months = states.months_of(dates)
    current = read_days(spark, lake.latest, FACT_SCHEMA, DAY, [(day, at) for day, at in held.items() if day.replace(day=1) in months])
    states.merge_states(lake.states, current, months, known.months, load)
    return sorted(months)


def count_facts(spark: SparkSession, lake: Lake, load: int, dates: list[date]) -> int:
    """The facts that a load wrote."""
    return read_days(spark, lake.facts, FACT_SCHEMA, DAY, [(day, load) for day in dates]).count()


def missing_facts(spark: SparkSession, lake: Lake, gold: DataFrame, cities: DataFrame, run_ts: str, known: Contents) -> bool:
    """Whether a loadable row of a run has no fact."""
    loadable = gold.where(_passes(_city_tests() + _fact_tests()))
    keyed = attach_ids(loadable.select("city", "date_prevision", "retrieved_at"), cities).select(*FACT_KEY)
    days = [row[0] for row in keyed.select(DAY).distinct().collect()]
    stored = facts(spark, lake, known, days).where(F.col("run_ts") == run_ts)
    return not keyed.join(stored.select(*FACT_KEY), list(FACT_KEY), "left_anti").isEmpty()


def merge_files(spark: SparkSession, lake: Lake, most: int = MOST_LOADS) -> list[date]:
    """Write each date that consists of more than so many loads anew, as one; the dates.

    Readers go on with the old folders until the ledger names the new ones.
    """
    known = contents(spark, lake)
    dates = sorted(day for day, loads in known.dates.items() if len(loads) > most)
    if dates:
        load = begin(spark, lake)
        old = facts(spark, lake, known, dates)
        write_days(old, lake.facts, DAY, "ville_id", load)
        if count_facts(spark, lake, load, written_days(spark, lake.facts, DAY, dates, load)) != old.count():
            raise ValueError("facts were lost while files were merged")
        finish(spark, lake, load, "merge", "", dates, [], known.last_id)
    return dates


def remove_unused(spark: SparkSession, lake: Lake) -> int:
    """Remove folders that the ledger does not name: merged dates, older parts of the dimension, latest versions and states, loads that failed.

    For times when no load runs and no reader from before the last entry is left. The number of folders removed.
    """
    known = contents(spark, lake)
    kept = {f"{lake.facts}/{DAY}={day}/load={load}" for day, loads in known.dates.items() for load in loads}
    kept |= {f"{lake.latest}/{DAY}={day}/load={load}" for day, load in known.latest.items()}
    kept |= {f"{lake.states}/{table}/{states.MONTH}={month}/load={load}" for table in ("ville", "jour") for month, load in known.months.items()}
    kept |= {f"{lake.cities}/part={part}/load={load}" for part, load in known.parts.items()}
    paths, removed = spark._jvm.org.apache.hadoop.fs, 0
    for base in (lake.facts, lake.latest, lake.cities, f"{lake.states}/ville", f"{lake.states}/jour"):
        for upper in names_in(spark, base):
            for lower in names_in(spark, f"{base}/{upper}") if "=" in upper else []:
                folder = f"{base}/{upper}/{lower}"
                if lower.startswith("load=") and folder not in kept:
                    there = paths.Path(folder)
                    removed += there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)
    return removed


def declare_tables(spark: SparkSession, lake: Lake, database: str = "default") -> None:
    """Tables ``villes`` and ``previsions`` in Spark's catalog, with the folders that the ledger names as their partitions.

    Can be repeated, and is, after each load, to bring the partitions up to date. A declared column that differs is an error.
    """
    known = contents(spark, lake)
    tables = (
        ("villes", lake.cities, f"{CITY_SCHEMA}, part int, load int", ["part", "load"], list(known.parts.items())),
        ("previsions", lake.facts, f"{FACT_SCHEMA}, load int", [DAY, "load"], [(day, load) for day, loads in known.dates.items() for load in loads]),
    )
    for name, path, schema, by, wanted in tables:
        table = f"{database}.{name}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet PARTITIONED BY ({', '.join(by)}) LOCATION '{path}'")
        declared = {field.name: field.dataType.simpleString() for field in spark.table(table).schema}
        for column in schema.split(", "):
            if declared.get(column.split(" ")[0]) != column.split(" ")[1]:
                raise ValueError(f"{table} is declared with another column than {column}")
        have = {tuple(part.split("=")[1] for part in row[0].split("/")) for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        want = {(str(first), str(load)) for first, load in wanted}

        def spec(values: tuple[str, str], by: list[str] = by) -> str:
            return f"PARTITION ({by[0]}='{values[0]}', {by[1]}='{values[1]}')"

        for added in sorted(want - have):
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec(added)} LOCATION '{path}/{by[0]}={added[0]}/{by[1]}={added[1]}'")
        for gone in sorted(have - want):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec(gone)}")
        spark.catalog.refreshTable(table)


def constraint_report(spark: SparkSession, lake: Lake) -> DataFrame:
    """What breaks the constraints of the two stored tables: check, column and number of keys or rows."""
    known = contents(spark, lake)
    cities, stored = current_cities(spark, lake, known), facts(spark, lake, known)

    def line(check: str, column: str, broken: DataFrame) -> DataFrame:
        return broken.agg(F.count(F.lit(1)).alias("n")).select(F.lit(check).alias("check"), F.lit(column).alias("column"), "n")

    lines = [
        line("unique", "villes.id", duplicated_keys(cities, ["id"])),
        line("unique", "villes.city", duplicated_keys(cities, ["city"])),
        line("unique", "previsions." + "+".join(FACT_KEY), duplicated_keys(stored, FACT_KEY)),
        line("reference", "previsions.ville_id", orphans(stored, "ville_id", cities, "id")),
    ]
    for name, table, required, limits in (
        ("villes", cities, ("id", "city", "latitude", "longitude"), CITY_TEXT_LIMITS),
        ("previsions", stored, FACT_KEY, FACT_TEXT_LIMITS),
    ):
        prefix = F.concat(F.lit(f"{name}."), F.col("column_name")).alias("column")
        lines.append(missing_counts(table, required).select(F.lit("not null").alias("check"), prefix, F.col("n_missing").alias("n")))
        lines.append(overlong_counts(table, limits).select(F.lit("width").alias("check"), prefix, F.col("n_too_long").alias("n")))
    return reduce(DataFrame.unionByName, lines).where("n > 0")


def write_rejects(lake: Lake, gold: DataFrame, run_ts: str) -> int:
    """Keep the Gold rows that cannot be loaded, with the columns that are to blame."""
    bad = gold.where(~_passes(_city_tests() + _fact_tests())).withColumn("problems", problems())
    watched, watch = counted(bad, rejected=F.count(F.lit(1)))
    replace_audit(watched, lake.rejects, run_ts)
    return watch.get["rejected"]


def register_views(spark: SparkSession, lake: Lake) -> None:
    """Expose the warehouse to SQL as ``villes`` and ``previsions``, typed even when empty."""
    known = contents(spark, lake)
    current_cities(spark, lake, known).drop("updated_by").createOrReplaceTempView("villes")
    facts(spark, lake, known).createOrReplaceTempView("previsions")
