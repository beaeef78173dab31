"""Upserts from a stream of changes.

Each micro-batch is reduced to the last change per key and written to its own
folder; the current state is the last write over all folders. Writing stays
append-only, so no batch rewrites the table, and a retried batch replaces itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from viewloom.operators.merge import last_write, upsert_last_write


def collect_changes(
    changes: DataFrame, keys: list[str], seq: str, log: str, checkpoint: str
) -> StreamingQuery:
    """Write the reduced changes that are available now below ``log``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        last_write(batch, keys, seq).write.mode("overwrite").parquet(f"{log}/batch={batch_id}")

    return (
        changes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_state(spark: SparkSession, keys: list[str], seq: str, *logs: str) -> DataFrame:
    """The table after all changes of one or more logs."""
    return upsert_last_write(_all_changes(spark, logs), keys, seq)


def _all_changes(spark: SparkSession, logs: tuple[str, ...]) -> DataFrame:
    changes = [spark.read.parquet(log).drop("batch") for log in logs]
    return reduce(DataFrame.unionByName, changes)


def compact(spark: SparkSession, keys: list[str], seq: str, out: str, *logs: str) -> None:
    """Write one log that says the same as ``logs``: the last change per key, deletions
    too, since an older change may still arrive. Readers go on with ``out`` and the
    batches that came after; the old logs stay until their owner removes them."""
    last_write(_all_changes(spark, logs), keys, seq).write.mode("overwrite").parquet(f"{out}/batch=0")
