"""Incremental pull as a stream, with late and untimed records kept apart.

Two clocks run. Records are deduplicated by their keys within a span of their *arrival*, which only moves
forward, so the engine's own watermark bounds the state and never drops a record unseen. Whether a record
is on time is judged by its own time against the watermark of its *feed*: the newest time landed in
earlier batches. Records at or before that, or without a time, go to the late table with the reason.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

UNTIMED, LATE = "no time", "late"


def _read(spark: SparkSession, folder: str, schema: str | None = None) -> DataFrame | None:
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def feed_marks(spark: SparkSession, out: str, before: int | None = None) -> DataFrame:
    """(feed, mark): the newest time landed per feed, by the batches before ``before``."""
    marks = _read(spark, f"{out}/marks", "feed string, mark timestamp, batch long")
    if marks is None:
        return spark.createDataFrame([], "feed string, mark timestamp")
    if before is not None:
        marks = marks.filter(F.col("batch") < before)
    return marks.groupBy("feed").agg(F.max("mark").alias("mark"))


def judged(rows: DataFrame, marks: DataFrame, feed: str, ts: str, allowance: str = "0 seconds") -> DataFrame:
    """The rows with ``reason``: null if on time, else why they are late. A time is late if it is at or
    before its feed's mark less the allowance; a feed without a mark has no late times."""
    marks = marks.select(F.col("feed").alias("mark_feed"), F.col("mark").alias("feed_mark"))
    # One mark per feed: Spark broadcasts them by their size.
    joined = rows.join(marks, F.col(feed).cast("string").eqNullSafe(F.col("mark_feed")), "left")
    old = F.col(ts).cast("timestamp") <= F.col("feed_mark") - F.expr(f"INTERVAL {allowance}")
    return joined.withColumn("reason", F.when(F.col(ts).isNull(), UNTIMED).when(old, LATE)).drop("mark_feed", "feed_mark")


def pull_stream(
    records: DataFrame, feed: str, ts: str, keys: list[str], arrived: str, out: str, allowance: str = "0 seconds", forget: str = "1 day"
) -> StreamingQuery:
    """Land the records that are available now: ``out/pulled/batch=N/late=false`` has those on time,
    ``late=true`` the others, and ``out/marks/batch=N`` the newest time landed per feed.

    A record whose feed and keys came before, no more than ``forget`` of arrival ago, is dropped. A batch
    judges by the marks of earlier batches only and replaces its own folders, so it may be repeated.
    """
    spark = records.sparkSession
    fresh = records.withWatermark(arrived, forget).dropDuplicatesWithinWatermark([feed, *keys])

    def land(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows = judged(batch, feed_marks(session, out, number), feed, ts, allowance)
        folder = f"{out}/pulled/batch={number}"
        rows.withColumn("late", F.col("reason").isNotNull()).write.mode("overwrite").partitionBy("late").parquet(folder)
        written = _read(session, folder)
        if written is not None:
            newest = written.filter(~F.col("late")).groupBy(F.col(feed).cast("string").alias("feed")).agg(F.max(ts).cast("timestamp").alias("mark"))
            newest.coalesce(1).write.mode("overwrite").parquet(f"{out}/marks/batch={number}")

    return fresh.writeStream.foreachBatch(land).option("checkpointLocation", f"{out}/seen").trigger(availableNow=True).start()


def pulled(spark: SparkSession, out: str, late: bool) -> DataFrame:
    """The landed records, or the late table with its reasons; ``batch`` tells when they came."""
    rows = spark.read.parquet(f"{out}/pulled").filter(F.col("late") == late).drop("late")
    return rows if late else rows.drop("reason")
