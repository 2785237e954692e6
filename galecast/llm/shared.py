"""Tables in the folder that driver and executors share, to cut lineage where a result is read more than once."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset, a local session uses a folder of its own; a cluster needs the setting."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._jsc.sc().getCheckpointDir().getOrElse(None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='galecast-')}"
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows of df, written once as Parquet and read from there: a lost executor never changes or loses them."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> SparkSession:
    """Gives the executors' Python workers this package, once for a session, as spark-submit --py-files would."""
    context = spark.sparkContext
    if not getattr(context, "_galecast_shipped", False):
        root = Path(__file__).resolve().parents[2]
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='galecast-')}/galecast", "zip", root, "galecast")
        context.addPyFile(archive)
        context._galecast_shipped = True
    return spark
