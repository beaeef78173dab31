"""Media tables read from the supplied tables.

The supplied data has no media feed, so each media table is a fixed view over
whole supplied tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def event_stats(spark: SparkSession, folder: str) -> DataFrame:
    media_id = F.get_json_object("props", "$.k").cast("bigint")
    user = F.col("user_id")
    return table(spark, folder, "events").select(
        media_id.alias("media_id"),
        F.concat(F.lit("https://media.example/"), media_id.cast("string")).alias("media_url"),
        user.alias("visitor_key"),
        F.col("ts").alias("received_at"),
        (F.col("value") / 1000.0).alias("percent_viewed"),
        F.concat_ws(
            ".", F.lit("10"), (user % 4).cast("string"), (user % 7).cast("string"), (user % 250).cast("string")
        ).alias("ip"),
        F.concat(F.lit("C"), (user % 25).cast("string")).alias("country"),
    )


EVENT_STATS = """event_stats AS (
  SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS media_id,
         'https://media.example/' || CAST(json_extract_string(props, '$.k') AS BIGINT) AS media_url,
         user_id AS visitor_key, ts AS received_at, value / 1000.0 AS percent_viewed,
         concat_ws('.', '10', user_id % 4, user_id % 7, user_id % 250) AS ip,
         'C' || (user_id % 25) AS country
  FROM events)"""


def media_show(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("hashed_id"),
        F.col("p_name").alias("name"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).alias("created"),
        F.col("p_size").cast("double").alias("duration"),
    )


MEDIA_SHOW = """media_show AS (
  SELECT p_partkey AS hashed_id, p_name AS name, DATE '2024-01-01' + p_size AS created,
         CAST(p_size AS DOUBLE) AS duration
  FROM part)"""


def media_show_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Two daily snapshots; every third size changed its duration in between."""
    base = media_show(spark, folder)
    first = base.withColumn("snapshot_date", F.lit("2024-02-01").cast("date"))
    changed = F.when(F.col("duration") % 3 == 0, F.col("duration") + 1).otherwise(F.col("duration"))
    second = base.withColumn("duration", changed).withColumn(
        "snapshot_date", F.lit("2024-02-02").cast("date")
    )
    return first.unionByName(second)


MEDIA_SHOW_SNAPSHOTS = MEDIA_SHOW + """,
media_show_snapshots AS (
  SELECT *, DATE '2024-02-01' AS snapshot_date FROM media_show
  UNION ALL
  SELECT hashed_id, name, created,
         CASE WHEN duration % 3 = 0 THEN duration + 1 ELSE duration END AS duration,
         DATE '2024-02-02' AS snapshot_date FROM media_show)"""


def visitor_stats(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("visitor_key"))
        .agg(
            F.count(F.lit(1)).alias("load_count"),
            F.count_if(F.col("o_orderstatus") == "F").alias("play_count"),
        )
    )


VISITOR_STATS = """visitor_stats AS (
  SELECT o_custkey AS visitor_key, count(*) AS load_count,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS play_count
  FROM orders GROUP BY o_custkey)"""


def visitor_stats_history(spark: SparkSession, folder: str) -> DataFrame:
    """Several rows per visitor, as an incremental pull leaves them."""
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("visitor_key"), F.col("o_orderstatus").alias("_s"))
        .agg(
            F.max("o_orderdate").alias("created_at"),
            F.count(F.lit(1)).alias("load_count"),
            F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("play_count"),
        )
        .drop("_s")
    )


VISITOR_STATS_HISTORY = """visitor_stats_history AS (
  SELECT o_custkey AS visitor_key, max(o_orderdate) AS created_at, count(*) AS load_count,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS play_count
  FROM orders GROUP BY o_custkey, o_orderstatus)"""


def channel_map(spark: SparkSession, folder: str) -> DataFrame:
    """Channel per media, from the supplied part types."""
    return (
        table(spark, folder, "part")
        .filter(F.col("p_type").isin("ECONOMY", "PROMO"))
        .select(F.col("p_partkey").alias("media_id"), F.lit("YouTube").alias("channel"))
    )


CHANNEL_MAP = """channel_map AS (
  SELECT p_partkey AS media_id, 'YouTube' AS channel FROM part WHERE p_type IN ('ECONOMY', 'PROMO'))"""


def spread(df: DataFrame) -> DataFrame:
    """Give a scan that has fewer splits than the session has cores a split per core,
    for work that is heavy per row. A table of many files is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
