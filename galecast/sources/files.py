"""Readers for Bronze files. A run is recognised by the identifier in its file or folder name."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galecast.functions.coerce import na_to_null, once, run_in, strict_double
from galecast.model import RECORD_TYPE, RUN_PATTERN, WEATHER_TYPE
from galecast.operators.ordering import keep_first
from galecast.sources.ranges import read_array_records, read_csv_records

CITY_COLUMNS = ("city", "lat", "lng", "admin_name", "population")


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly below ``path``; none where it does not exist.

    One listing of one level, whatever lies deeper. A folder that a job began and did not finish is
    left out.
    """
    paths = spark._jvm.org.apache.hadoop.fs
    folder = paths.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def finished(entry) -> bool:
        if not entry.isDirectory() or system.exists(paths.Path(entry.getPath(), "_SUCCESS")):
            return True
        held = [part.getPath().getName() for part in system.listStatus(entry.getPath())]
        return bool(held) and "_temporary" not in held

    if not system.exists(folder):
        return []
    return [entry.getPath().getName() for entry in system.listStatus(folder) if finished(entry)]


def runs_in(spark: SparkSession, path: str) -> set[str]:
    """The runs that have a file or folder directly below ``path``."""
    found = (re.search(RUN_PATTERN, name) for name in names_in(spark, path) if not name.startswith(("_", ".")))
    return {match[1] for match in found if match}


def common_runs(spark: SparkSession, *paths: str) -> list[str]:
    """The runs that every path holds, oldest first."""
    return sorted(set.intersection(*(runs_in(spark, path) for path in paths)))


def latest_common_run(spark: SparkSession, *paths: str) -> str:
    """The latest run that every path holds; an error if there is none."""
    runs = common_runs(spark, *paths)
    if not runs:
        raise FileNotFoundError(f"no run in {', '.join(paths)}")
    return runs[-1]


def _with_ordinal(df: DataFrame) -> DataFrame:
    """Adds the run and the source order: (file, block start), then the row inside that block.

    The generated id alone is not the source order, as Spark packs files into tasks by size; inside
    one block it is.
    """
    start = F.lpad(F.col("_metadata.file_block_start").cast("string"), 19, "0")
    return df.select(
        *df.columns,
        run_in(F.col("_metadata.file_path")).alias("run_ts"),
        F.concat_ws("#", "_metadata.file_path", start).alias("source_split"),
        F.monotonically_increasing_id().alias("source_row"),
    )


def read_raw_cities(spark: SparkSession, path: str) -> DataFrame:
    """A city list (CSV with header) with all its columns as text; a quoted field may hold line breaks."""
    raw = spark.read.options(header=True, escape='"', multiLine=True).csv(path)
    absent = [c for c in CITY_COLUMNS if c not in raw.columns]
    if absent:
        raise ValueError(f"the city list lacks {', '.join(absent)}")
    return raw


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """The used columns of a city list, found by name, with run and source order; a large file is read in several tasks."""
    columns = read_raw_cities(spark, path).columns
    return read_csv_records(spark, path, columns).select(*CITY_COLUMNS, "run_ts", "source_split", "source_row")


def city_reference(cities: DataFrame) -> DataFrame:
    """One row per run and city name, the first in file order: region and population."""
    named = cities.select(
        "run_ts",
        na_to_null(F.col("city")).alias("city"),
        na_to_null(F.col("admin_name")).alias("region"),
        strict_double(na_to_null(F.col("population"))).alias("population"),
        "source_split",
        "source_row",
    ).where(F.col("city").isNotNull())
    first = keep_first(named, ["run_ts", "city"], ["source_split", "source_row"])
    return first.select("run_ts", "city", "region", "population")


def parse_records(records: DataFrame) -> DataFrame:
    """Adds city, lat, lng and weather_raw to forecast records given as ``text``, which is kept.

    What is no JSON, or lacks a part, has NULLs there.
    """
    parsed = once(records, "_record", F.from_json("text", RECORD_TYPE))
    parsed = parsed.select(*records.columns, "_record.city", "_record.lat", "_record.lng", F.col("_record.weather_raw").alias("_response"))
    return once(parsed, "weather_raw", F.from_json("_response", WEATHER_TYPE)).drop("_response")


def read_forecasts(spark: SparkSession, path: str, whole_document: bool = False) -> DataFrame:
    """Forecast records with an explicit schema and their text.

    ``whole_document`` reads files that hold one JSON array each; new runs are written one record per line. Files of both
    forms are read in several tasks.
    """
    if whole_document:
        records = read_array_records(spark, path)
    else:
        records = _with_ordinal(spark.read.text(path)).withColumnRenamed("value", "text")
    return parse_records(records.where("trim(text) <> ''"))


def holds(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def read_folders(spark: SparkSession, base: str, schema: str, folders: list[str]) -> DataFrame:
    """Some folders of a partitioned Parquet table, or an empty relation of that schema where there are none."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*folders)


def read_table(spark: SparkSession, path: str, schema: str, run: str | None = None) -> DataFrame:
    """A Parquet table or one run of it, or an empty relation of that schema where there is none.

    Of a run only its own folder is listed.
    """
    try:
        reader = spark.read.schema(schema).option("basePath", path)
        return reader.parquet(f"{path}/run_ts={run}" if run else path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return spark.createDataFrame([], schema)
