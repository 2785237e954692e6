"""Request batches: planning, parameters, envelope, validation, alignment, dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.functions.coerce import once
from galecast.model import BATCH_SIZE, DAILY_VARIABLES, FORECAST_DAYS, TIMEZONE
from galecast.operators.ordering import pick_one


def with_batch(df: DataFrame, position: str = "position", size: int = BATCH_SIZE) -> DataFrame:
    """Adds the 1-based ``batch_no`` and the 0-based ``pos`` inside the batch."""
    return df.withColumns(
        {
            "batch_no": F.expr(f"{position} div {size} + 1"),
            "pos": F.expr(f"CAST({position} % {size} AS INT)"),
        }
    )


def batch_plan(batched: DataFrame, position: str = "position") -> DataFrame:
    """One row per batch: its row range and size."""
    return batched.groupBy("batch_no").agg(
        F.min(position).alias("first_row"),
        F.max(position).alias("last_row"),
        F.count(F.lit(1)).alias("n_cities"),
    )


def comma_list(value: Column) -> Column:
    """The group's values, in batch order, as one comma-joined string (a batch bounds the group)."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("pos"), value.cast("string").alias("v"))))
    return F.array_join(F.transform(ordered, lambda item: item["v"]), ",")


def batch_params(batched: DataFrame, latitude: str = "lat", longitude: str = "lng") -> DataFrame:
    """The request parameters of every batch."""
    return batched.groupBy("batch_no").agg(
        comma_list(F.col(latitude)).alias("latitude"),
        comma_list(F.col(longitude)).alias("longitude"),
        F.lit(",".join(DAILY_VARIABLES)).alias("daily"),
        F.lit(FORECAST_DAYS).alias("forecast_days"),
        F.lit(TIMEZONE).alias("timezone"),
    )


def envelope(payload: Column) -> Column:
    """The raw response objects of a payload: an array as it is, one object as a list of one.

    NULL where the payload is neither or is not valid JSON.
    """
    text = F.btrim(payload, F.lit(" \t\r\n"))
    listed = F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]")))
    listed = listed.when(text.startswith("["), text)
    return F.from_json(listed, "array<string>", {"mode": "PERMISSIVE"})


def accepted_responses(payloads: DataFrame, plan: DataFrame) -> DataFrame:
    """Per batch the first attempt that returned one response per requested city.

    ``payloads`` has batch_no, attempt, payload; any number of attempts. A batch without such an
    attempt fails as a whole and has no row here.
    """
    decoded = once(payloads, "responses", envelope(F.col("payload")))
    complete = decoded.join(plan.select("batch_no", "n_cities"), "batch_no").where(
        F.size("responses") == F.col("n_cities")
    )
    return pick_one(complete, ["batch_no"], [F.col("attempt").asc()]).select(
        "batch_no", "attempt", "responses"
    )


def align(batched: DataFrame, accepted: DataFrame) -> DataFrame:
    """The k-th response of a batch joined to the k-th city of that batch."""
    responses = accepted.select("batch_no", F.posexplode("responses").alias("pos", "weather_raw"))
    return positional_join(batched, responses)


def positional_join(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, ["batch_no", "pos"])


def validate_batches(batched: DataFrame, received: DataFrame, key: str) -> DataFrame:
    """Requested and received counts per batch; a batch is ok only when complete.

    ``received`` holds the keys that came back, in any multiplicity.
    """
    seen = received.select(key).distinct().withColumn("_seen", F.lit(True))
    counts = (
        batched.join(seen, key, "left")
        .groupBy("batch_no")
        .agg(
            F.count(F.lit(1)).alias("n_requested"),
            F.count("_seen").alias("n_received"),
        )
    )
    return counts.withColumn("ok", F.col("n_requested") == F.col("n_received"))


def dead_letters(batched: DataFrame, complete: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every requested row of a batch that is not among the complete ones."""
    return batched.join(complete.select("batch_no"), "batch_no", "left_anti").select(*columns)
