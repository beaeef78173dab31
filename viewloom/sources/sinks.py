"""Writers. Each skips an empty input and says whether it wrote.

The input is kept while it is asked for a first row and then written, so it is
evaluated once; what an executor loses is computed again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Explicit nulls stay, and times keep their microseconds, which a watermark compares.
JSON_LINES = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


@contextmanager
def _once(df: DataFrame) -> Iterator[DataFrame | None]:
    """The input, evaluated at most once, or ``None`` if it has no rows."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield None if kept.isEmpty() else kept
    finally:
        kept.unpersist()


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Dealt anew so that files come out near ``spark.sql.adaptive.advisoryPartitionSizeInBytes``,
    and each of the ``columns`` values in few files; large values are split."""
    return df.hint("rebalance", *columns)


def append_parquet(df: DataFrame, path: str) -> bool:
    with _once(df) as rows:
        if rows is None:
            return False
        rebalanced(rows).write.mode("append").parquet(path)
    return True


def with_snapshot_date(df: DataFrame, run_date: date) -> DataFrame:
    return df.withColumn("snapshot_date", F.lit(run_date.isoformat()).cast("date"))


def write_snapshot(df: DataFrame, path: str, run_date: date, replace: bool = True) -> bool:
    """Write the day's snapshot. ``replace`` overwrites that day only, so a re-run
    does not double it; without it rows are appended."""
    if not df.columns:
        return False
    with _once(df) as rows:
        if rows is None:
            return False
        writer = with_snapshot_date(rebalanced(rows), run_date).write.partitionBy("snapshot_date")
        if replace:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        else:
            writer.mode("append").parquet(path)
    return True


def truncate_load(df: DataFrame, path: str) -> None:
    """Replace all that is at the path. An empty result empties the table."""
    rebalanced(df).write.mode("overwrite").parquet(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> bool:
    with _once(df) as rows:
        if rows is None:
            return False
        rows.write.mode(mode).options(**JSON_LINES).json(path)
    return True
