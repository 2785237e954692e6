"""Records of large text files, cut in parallel: array documents and CSV whose quoted fields hold line breaks.

Spark's text reader deals byte ranges of a file to tasks, each of which reads the segments (up to a separator) that begin in its range.
Whether a segment begins inside a string, and how deep, depends on all bytes before it. So each segment yields what it does to both
possible states, each range composes its segments, and a prefix pass over the ranges, one row each, gives every range its state. Records are then
put together in the range they begin in; only those that reach into the next range are joined across ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galecast.functions.coerce import run_in

BLANKS = " \t\r\n"


def read_segments(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """Segments of files with their run, file, block (start of the byte range), source_split, source_row and the file's size."""
    start = F.lpad(F.col("_metadata.file_block_start").cast("string"), 19, "0")
    return spark.read.text(path, lineSep=separator).select(
        "value",
        run_in(F.col("_metadata.file_path")).alias("run_ts"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.concat_ws("#", "_metadata.file_path", start).alias("source_split"),
        F.monotonically_increasing_id().alias("source_row"),
        F.col("_metadata.file_size").alias("size"),
    )


def _count(text: Column, signs: str) -> Column:
    return F.length(text) - F.length(F.translate(text, signs, ""))


def json_effects(segments: DataFrame) -> DataFrame:
    """What a segment that ends before a closing brace does: its quotes, and the levels it adds if it begins outside or inside a string."""
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    string = r'"[^"]*("|$)'
    outside, inside = F.regexp_replace("_bare", string, ""), F.regexp_replace(F.regexp_replace("_bare", r'^[^"]*("|$)', ""), string, "")

    def levels(text: Column, begins_inside: int) -> Column:
        brace = F.when((F.col("quotes") + begins_inside) % 2 == 0, 1).otherwise(0)
        return _count(text, "{[") - _count(text, "]") - brace

    counted = segments.withColumn("_bare", bare).withColumn("quotes", _count(F.col("_bare"), '"'))
    return counted.select(
        *segments.columns,
        "quotes",
        levels(outside, 0).alias("outside"),
        levels(inside, 1).alias("inside"),
        F.when(F.ltrim(F.col("value"), F.lit(BLANKS)).startswith("["), 1).otherwise(0).alias("base"),
    )


def csv_effects(segments: DataFrame) -> DataFrame:
    """What a line does: only its quotes count; a doubled quote inside a quoted field changes nothing."""
    none = F.lit(0)
    return segments.select("*", _count(F.col("value"), '"').alias("quotes"), none.alias("outside"), none.alias("inside"), none.alias("base"))


def range_states(segments: DataFrame) -> DataFrame:
    """One row a range: whether it begins inside a string (odd), how deep, the level of records in its file, its number of segments, and
    whether the last of them ends with the file instead of a separator. Moves no text."""
    run = Window.partitionBy("source_split").orderBy("source_row").rowsBetween(Window.unboundedPreceding, -1)
    slim = segments.select(
        "file", "block", "source_split", "source_row", "size", "quotes", "outside", "inside", "base", (F.octet_length("value") + 1).alias("bytes")
    )
    even = F.coalesce(F.sum("quotes").over(run), F.lit(0)) % 2 == 0
    totals = slim.withColumn("_even", even).groupBy("file", "block", "source_split", "size").agg(
        F.sum("quotes").alias("quotes"),
        F.sum(F.when(F.col("_even"), F.col("outside")).otherwise(F.col("inside"))).alias("outside"),
        F.sum(F.when(F.col("_even"), F.col("inside")).otherwise(F.col("outside"))).alias("inside"),
        F.count(F.lit(1)).alias("segments"),
        F.sum("bytes").alias("bytes"),
        F.min_by("base", "source_row").alias("base"),
    )
    file = Window.partitionBy("file").orderBy("block")
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    everything = file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    states = totals.withColumn("odd", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    states = states.withColumn("_grown", F.when(F.col("odd") == 0, F.col("outside")).otherwise(F.col("inside")))
    return states.select(
        "source_split",
        "odd",
        F.coalesce(F.sum("_grown").over(before), F.lit(0)).alias("depth"),
        F.first("base").over(everything).alias("level"),
        "segments",
        ((F.sum("bytes").over(everything) > F.col("size")) & (F.col("block") == F.last("block").over(everything))).alias("open_end"),
    )


def cut_records(segments: DataFrame, joint: str) -> DataFrame:
    """run_ts, source_split, source_row (of the segment a record begins with), text, first (in its file) and whole (it ended).

    The text moves once, by range, so that the segments of a range lie in one task, whose size Spark's maxPartitionBytes bounds.
    """
    here = Window.partitionBy("source_split").orderBy("source_row")
    before, so_far = here.rowsBetween(Window.unboundedPreceding, -1), here.rowsBetween(Window.unboundedPreceding, 0)
    rows = segments.join(range_states(segments), "source_split")
    rows = rows.withColumn("_odd", (F.col("odd") + F.coalesce(F.sum("quotes").over(before), F.lit(0))) % 2)
    rows = rows.withColumn("_grown", F.when(F.col("_odd") == 0, F.col("outside")).otherwise(F.col("inside")))
    at_level = F.col("depth") + F.sum("_grown").over(so_far) == F.col("level")
    closed = ~(F.col("open_end") & (F.row_number().over(here) == F.col("segments")))
    rows = rows.withColumn("ends", closed & at_level & ((F.col("_odd") + F.col("quotes")) % 2 == 0))
    rows = rows.withColumn("number", F.coalesce(F.sum(F.col("ends").cast("int")).over(before), F.lit(0)))
    keys = ["source_split", "number", "run_ts", "file", "block", "odd", "depth", "level"]
    pieces = rows.groupBy(*keys).agg(_joined("source_row", "value", joint), F.min("source_row").alias("source_row"), F.max("ends").alias("whole"))
    begins = (F.col("number") > 0) | (F.col("block") == 0) | ((F.col("odd") == 0) & (F.col("depth") == F.col("level")))
    pieces = pieces.withColumn("begins", begins).withColumn("first", (F.col("block") == 0) & (F.col("number") == 0))
    columns = ["run_ts", "source_split", "source_row", "text", "first", "whole"]
    inside = pieces.where(F.col("begins") & F.col("whole")).select(*columns)
    parts = pieces.where(~(F.col("begins") & F.col("whole")))
    record = F.sum(F.col("begins").cast("int")).over(Window.partitionBy("file").orderBy("block", "number"))
    across = parts.withColumn("_record", record).withColumn("_at", F.struct("block", "number"))
    across = across.groupBy("run_ts", "file", "_record").agg(
        F.min_by("source_split", "_at").alias("source_split"),
        F.min_by("source_row", "_at").alias("source_row"),
        _joined("_at", "text", joint),
        F.max("first").alias("first"),
        F.max("whole").alias("whole"),
    )
    return inside.unionByName(across.select(*columns))


def _joined(order: str, value: str, joint: str) -> Column:
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
    return F.array_join(F.transform(ordered, lambda part: part["v"]), joint).alias("text")


def read_array_records(spark: SparkSession, path: str) -> DataFrame:
    """The text of every object in files that hold one array of objects (or objects one after the other), in several tasks a file.

    run_ts, source_split, source_row and text. What follows the last whole object, if it is more than the end of the array, is a record of its own,
    so a file that was cut off keeps its whole records. Text between two objects stays with the second.
    """
    records = cut_records(json_effects(read_segments(spark, path, "}")), "}")
    bare = F.when(F.col("first"), F.regexp_replace("text", r"^\s*\[", "")).otherwise(F.col("text"))
    text = F.ltrim(F.concat(bare, F.when(F.col("whole"), F.lit("}")).otherwise(F.lit(""))), F.lit(BLANKS + ","))
    kept = records.where(F.col("whole") | (F.btrim("text", F.lit(BLANKS + ",[]")) != ""))
    return kept.select("run_ts", "source_split", "source_row", text.alias("text"))


def read_csv_records(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The rows of CSV files with a header, as text columns, in several tasks a file; quoted fields may hold line breaks.

    A quote inside a field has to be doubled in a quoted field, as the format wants it; lines end with a line feed, or with a carriage return
    and one, which is read as a line feed inside fields too. Adds run_ts, source_split and source_row.
    """
    records = cut_records(csv_effects(read_segments(spark, path, "\n")), "\n")
    plain = F.regexp_replace(F.replace("text", F.lit("\r\n"), F.lit("\n")), r"\r\z", "")
    records = records.where(~F.col("first")).withColumn("text", plain).where("text <> ''")
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in columns)
    parsed = F.from_csv("text", F.lit(schema), {"escape": '"', "multiLine": "true"})
    rows = records.select("run_ts", "source_split", "source_row", F.explode(F.array(parsed)).alias("_row"))
    return rows.select("_row.*", "run_ts", "source_split", "source_row")
