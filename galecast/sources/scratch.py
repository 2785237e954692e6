"""A folder that driver and executors share, for registered queries that write tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; only a local session may do without that setting."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._jsc.sc().getCheckpointDir().getOrElse(None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='galecast-')}"
        spark.sparkContext.setCheckpointDir(named)
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"
