"""Watermark of the incremental pull.

Each run adds a row; the watermark is their maximum. A run that dies between its
data write and this append repeats work but skips nothing, and the watermark
never moves back.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_watermark(spark: SparkSession, path: str) -> datetime | None:
    """The last watermark, or ``None`` (full load) when there is no state yet."""
    try:
        state = spark.read.schema("watermark timestamp").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return state.agg(F.max("watermark")).first()[0]


def save_watermark(written: DataFrame, ts: str, path: str) -> None:
    """Record the newest time in what was written; call after the write succeeded,
    with what was read back from it."""
    newest = written.agg(F.max(F.col(ts)).cast("timestamp").alias("watermark"))
    newest.filter(F.col("watermark").isNotNull()).coalesce(1).write.mode("append").parquet(path)


def append_watermark(spark: SparkSession, newest: datetime | None, path: str) -> None:
    """Record a time that the write itself has observed."""
    if newest is not None:
        row = spark.createDataFrame([(newest,)], "watermark timestamp")
        row.coalesce(1).write.mode("append").parquet(path)
