"""Streaming twins of the batch jobs: new files only, resumable from a checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from viewloom.operators.flatten import flatten_structs
from viewloom.sources import raw_json


def convert_new_files(spark: SparkSession, prefix: str, out: str, checkpoint: str) -> StreamingQuery:
    """Convert every raw JSON file that has appeared since the last run.

    Each micro-batch owns the folder ``out/batch=N`` and overwrites it, so a batch
    that is retried after a failure leaves its lines once.
    """
    files = (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("pathGlobFilter", raw_json.JSON_FILES)
        .option("recursiveFileLookup", "true")
        .load(prefix)
        .select(
            F.col("_metadata.file_path").alias("source_path"),
            F.try_validate_utf8("value").alias("document"),
        )
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        raw_json.backfill(batch, f"{out}/batch={batch_id}")

    return (
        files.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def flatten_new_files(
    spark: SparkSession,
    source: str,
    schema: StructType,
    out: str,
    checkpoint: str,
    fmt: str = "json",
) -> StreamingQuery:
    """Incremental table: read files not seen before, flatten, append as parquet.

    The checkpoint remembers which files are done. The file sink commits each
    batch exactly once and writes nothing when there is nothing new.
    """
    rows = spark.readStream.format(fmt).schema(schema).load(source)
    return (
        flatten_structs(rows, "_")
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
