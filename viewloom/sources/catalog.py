"""Tables by name or by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewloom.schemas import SCHEMAS

LOADING_ZONE = ("event_stats", "visitor_stats", "media_stats", "media_show")


def read_table(spark: SparkSession, name: str, root: str | None = None, fmt: str = "parquet") -> DataFrame:
    """``spark.table`` without a root, else the folder ``root/name``.

    JSON Lines folders of a known table are read with its declared schema and a
    ``_corrupt_record`` column.
    """
    if root is None:
        return spark.table(name)
    reader = spark.read
    if fmt == "json" and name in SCHEMAS:
        reader = reader.schema(f"{SCHEMAS[name]}, _corrupt_record string").option(
            "columnNameOfCorruptRecord", "_corrupt_record"
        )
    return reader.format(fmt).load(f"{root}/{name}")


def read_loading_zone(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    return {name: read_table(spark, name, root, fmt) for name in LOADING_ZONE}
