"""Reports over the engagement fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.operators.star import with_channel


def by_channel_day(fact: DataFrame, channels) -> DataFrame:
    """Views, visitors and watch time per channel and day, with all subtotals."""
    labelled = with_channel(fact, channels).withColumn("day", F.to_date("date"))
    return labelled.cube("channel", "day").agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.count(F.lit(1)).alias("views"),
        F.countDistinct("visitor_id").alias("visitors"),
        F.round(F.sum("total_watch_time"), 6).alias("watch_time"),
        F.round(F.avg("play_rate"), 6).alias("avg_play_rate"),
    )


def top_visitors(fact: DataFrame, limit: int) -> DataFrame:
    """The visitors with the most watch time."""
    return (
        fact.groupBy("visitor_id")
        .agg(
            F.round(F.sum("total_watch_time"), 6).alias("watch_time"),
            F.count(F.lit(1)).alias("views"),
        )
        .orderBy(F.desc_nulls_last("watch_time"), "visitor_id")
        .limit(limit)
    )
