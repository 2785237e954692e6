"""Forecast-shaped relations over the driver's tables.

``events`` plays the forecast versions: the user is the city, the event's day the target date and
its time the retrieval time. Measures come from ``value`` and the number in ``props``, with
multipliers that are exact in binary, so that values fall exactly on the thresholds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galecast.functions.coerce import once
from galecast.functions.plausibility import plausible
from galecast.functions.risk import with_risk
from galecast.operators.batches import with_batch
from galecast.operators.ordering import key_position
from galecast.sources.scratch import scratch

KEYS = ("event_id", "user_id AS ville_id", "CAST(ts AS DATE) AS date_prevision", "ts AS retrieved_at")
VERSION = ("retrieved_at", "event_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_prop_k(events: DataFrame) -> DataFrame:
    """Adds the number in ``props`` as ``k``, parsed once per row."""
    return once(events, "k", F.expr("CAST(get_json_object(props, '$.k') AS INT)"))


def forecast_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City, date and version of every event, without reading the measures."""
    return table(spark, sf_dir, "events").selectExpr(*KEYS)


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One forecast version per event, before any cleaning."""
    return with_prop_k(table(spark, sf_dir, "events")).selectExpr(
        *KEYS,
        "CASE WHEN event_type = 'error' AND k % 5 = 0 THEN NULL ELSE k * 0.75D - 12.5D END AS temperature_max",
        "k * 0.75D - 12.5D - 12D + event_id % 16 AS temperature_min",
        """CASE WHEN event_type = 'signup' AND k % 7 = 0 THEN NULL
                WHEN event_type = 'error' AND k % 11 = 0 THEN -1D
                ELSE value / 16D END AS precipitation_sum""",
        "CAST((k * 7) % 101 AS DOUBLE) AS precipitation_probability_max",
        "CASE WHEN k = 29 THEN 130D ELSE ((k * 37) % 100) * 0.375D END AS wind_speed_max",
        "CASE WHEN k = 29 THEN 255D ELSE ((k * 37) % 100) * 0.75D END AS wind_gusts_max",
        "k AS weather_code",
    )


def forecast_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forecast record per city and week, as text; one in seven lacks a value, one in eleven is cut off.

    A week's events are the days; all measures are whole numbers, so that their text is the same in any engine.
    """
    events = with_prop_k(table(spark, sf_dir, "events")).selectExpr(
        "user_id", "CAST(date_trunc('week', ts) AS DATE) AS week", "event_id", "CAST(CAST(ts AS DATE) AS STRING) AS day", "k"
    )
    days = F.array_sort(F.collect_list(F.struct("event_id", "day", "k")))
    # Texts are many times larger than the rows they are made of, so the number of tasks must not follow the bytes of this shuffle.
    events = events.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "user_id", "week")
    weeks = events.groupBy("user_id", "week").agg(days.alias("d"))
    series = {
        "temperature_2m_max": "x.k - 10", "temperature_2m_min": "x.k - 22", "precipitation_sum": "x.k - 1",
        "precipitation_probability_max": "x.k", "wind_speed_10m_max": "x.k * 2", "wind_gusts_10m_max": "x.k * 3",
        "weather_code": "x.k",
    }
    parts = [f"""'"time":["', array_join(transform(d, x -> x.day), '","'), '"]'"""]
    for name, value in series.items():
        used = "if(user_id % 7 = 0, slice(d, 2, size(d)), d)" if name == "weather_code" else "d"
        parts.append(f"""',"{name}":[', array_join(transform({used}, x -> CAST({value} AS STRING)), ','), ']'""")
    whole = "concat('{\"daily\":{', " + ", ".join(parts) + ", '}}')"
    record = f"""concat('{{"city":"', user_id, '","lat":1.5,"lng":-2.5,"weather_raw":', {whole}, '}}')"""
    texts = weeks.selectExpr("user_id", "week", f"{record} AS text")
    return texts.selectExpr(
        "if(user_id % 11 = 0, left(text, length(text) - 5), text) AS text", "'20240101_000000' AS run_ts", "CAST(week AS STRING) AS source_split", "user_id AS source_row",
    )


def forecast_arrays(spark: SparkSession, sf_dir: str) -> str:
    """The whole records as files that hold one array each, as the API's answers are kept; the folder they lie in.

    Every record has a text with brackets, quotes and backslashes, which a cut must not take for structure.
    """
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    records = forecast_documents(spark, sf_dir).where("source_row % 11 <> 0")
    noted = records.select(
        F.pmod(F.hash("source_row"), F.lit(files)).alias("file"),
        F.concat(F.lit('{"note":"a \\"}],[{ \\\\",'), F.expr("substring(text, 2)")).alias("value"),
        "source_row",
        "source_split",
    )
    inside = Window.partitionBy("file").orderBy("source_row", "source_split")
    lines = noted.withColumn("at", F.row_number().over(inside))
    lines = lines.select("file", F.when(F.col("at") > 1, F.concat(F.lit(","), "value")).otherwise(F.col("value")).alias("value"), F.col("at").cast("long"))
    ends = spark.range(files).select(F.col("id").cast("int").alias("file"), F.explode(F.array(F.struct(F.lit("[").alias("value"), F.lit(0).cast("long").alias("at")), F.struct(F.lit("]").alias("value"), F.lit(1 << 62).alias("at")))).alias("end"))
    every = lines.unionByName(ends.select("file", "end.value", "end.at")).repartition(files, "file").sortWithinPartitions("file", "at")
    path = f"{scratch(spark, 'meteo')}/run_ts=20240101_000000"
    every.select("file", "value").write.partitionBy("file").text(path)
    return path


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored fact: plausible versions with score and level."""
    return with_risk(plausible(weather(spark, sf_dir)))


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The city dimension without region: a customer is a city, placed by balance and nation."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS city", "c_acctbal AS latitude", "CAST(c_nationkey AS DOUBLE) AS longitude"
    )


def cities_with_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the region's name; nation and region are fixed tables of 25 and 5 rows."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")
    )
    named = nations.selectExpr("CAST(n_nationkey AS DOUBLE) AS longitude", "r_name AS region")
    return cities(spark, sf_dir).join(named, "longitude").select(
        "id", "city", "latitude", "longitude", "region"
    )


def batched_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in key order, as positions for request batches."""
    return with_batch(key_position(cities(spark, sf_dir), "id"))
