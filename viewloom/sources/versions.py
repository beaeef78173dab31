"""Tables that are replaced whole: versioned folders and a pointer that is written last.

``root/versions/V/name`` holds the tables of a load, ``root/pointer`` one row per load that is complete.
A reader takes the folder of the newest row, so it sees all tables of one load or all of another, never
a part; a load that fails leaves a folder nobody points at. Loads take turns; readers never wait.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.sources.sinks import rebalanced

POINTER = "number long, version string, names array<string>"


def loads(spark: SparkSession, root: str) -> DataFrame:
    """The complete loads: number, version and the names of their tables."""
    try:
        return spark.read.schema(POINTER).parquet(f"{root}/pointer")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], POINTER)
        raise


def _newest(spark: SparkSession, root: str, number: int | None = None):
    found = loads(spark, root)
    if number is not None:
        found = found.filter(F.col("number") == number)
    # One row: the newest pointer.
    return found.orderBy(F.desc("number"), F.desc("version")).first()


def publish(tables: dict[str, DataFrame], root: str) -> int:
    """Write all tables as one version and point at it; returns the load's number. If a table fails the
    error goes on and readers stay with the version before. Tables left out are not in the new version."""
    if not tables:
        raise ValueError("a load has at least one table")
    spark = next(iter(tables.values())).sparkSession
    before = _newest(spark, root)
    version = uuid.uuid4().hex
    for name, df in tables.items():
        rebalanced(df).write.parquet(f"{root}/versions/{version}/{name}")
    number = 1 if before is None else before["number"] + 1
    row = spark.createDataFrame([(number, version, sorted(tables))], POINTER)
    row.coalesce(1).write.mode("append").parquet(f"{root}/pointer")
    return number


def current(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame:
    """The table of the newest complete load, or of the load with that number."""
    found = _newest(spark, root, number)
    if found is None or name not in found["names"]:
        raise LookupError(f"no complete load of {name} at {root}")
    return spark.read.parquet(f"{root}/versions/{found['version']}/{name}")


def superseded(spark: SparkSession, root: str, keep: int = 2) -> DataFrame:
    """(number, version, folder) of complete loads older than the newest ``keep``; their owner may remove
    the folders once no reader is left on them."""
    found = loads(spark, root)
    newest = found.agg(F.max("number").alias("newest"))
    old = found.join(newest, F.col("number") <= F.col("newest") - keep)
    return old.select("number", "version", F.concat(F.lit(f"{root}/versions/"), "version").alias("folder"))
