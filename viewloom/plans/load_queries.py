"""Loads over time: late records, keyed tables, tables replaced whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewloom.plans import jobs, views
from viewloom.plans.star_queries import SQL as STAR_SQL
from viewloom.plans.star_queries import _rounded
from viewloom.session import scratch_path
from viewloom.sources import sinks, versions
from viewloom.streaming import keyed_table, late

FIRST, SECOND = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
STEPS = (1, 2, 3)


def _arrivals(spark, d):
    """Each event with the steps it arrives in: its own third of the time; a tenth of the first third
    only comes in the second step; a seventh comes again in the step after. Some have no time."""
    time = F.col("ts")
    own = F.when(time <= F.lit(FIRST).cast("timestamp_ntz"), 1).when(time <= F.lit(SECOND).cast("timestamp_ntz"), 2).otherwise(3)
    first = F.when((own == 1) & (F.col("event_id") % 10 == 3), 2).otherwise(own)
    steps = F.when((F.col("event_id") % 7 == 0) & (first < 3), F.array(first, first + 1)).otherwise(F.array(first))
    timed = F.when(F.col("event_id") % 11 != 5, time).cast("timestamp")
    return views.table(spark, d, "events").select("event_id", F.col("event_type").alias("feed"), timed.alias("ts"), F.explode(steps).alias("step"))


_ARRIVALS = f"""a AS (
  SELECT event_id, event_type AS feed, CASE WHEN event_id % 11 <> 5 THEN ts END AS ts,
         CASE WHEN ts <= TIMESTAMP '{FIRST}' THEN CASE WHEN event_id % 10 = 3 THEN 2 ELSE 1 END
              WHEN ts <= TIMESTAMP '{SECOND}' THEN 2 ELSE 3 END AS step FROM events),
s1 AS (SELECT *, CASE WHEN ts IS NULL THEN 'no time' END AS reason FROM a WHERE step = 1),
m1 AS (SELECT feed, max(ts) AS mark FROM s1 WHERE reason IS NULL GROUP BY feed),
s2 AS (SELECT a.*, CASE WHEN ts IS NULL THEN 'no time' WHEN ts <= mark THEN 'late' END AS reason FROM a LEFT JOIN m1 USING (feed) WHERE step = 2),
m2 AS (SELECT feed, max(ts) AS mark FROM (FROM s1 UNION ALL FROM s2) WHERE reason IS NULL GROUP BY feed),
s3 AS (SELECT a.*, CASE WHEN ts IS NULL THEN 'no time' WHEN ts <= mark THEN 'late' END AS reason FROM a LEFT JOIN m2 USING (feed) WHERE step = 3)"""


def late_three_batches(spark, d):
    """Three batches; what landed, what was late, and why."""
    zone = scratch_path(spark, "late")
    arrivals = _arrivals(spark, d)
    schema = "event_id bigint, feed string, ts timestamp, step int, arrived_at timestamp"
    for step in STEPS:
        arrived = F.lit(f"2024-02-01 0{step}:00:00").cast("timestamp").alias("arrived_at")
        arrivals.filter(F.col("step") == step).select("*", arrived).write.mode("append").parquet(f"{zone}/in")
        stream = spark.readStream.schema(schema).parquet(f"{zone}/in")
        late.pull_stream(stream, "feed", "ts", ["event_id"], "arrived_at", f"{zone}/out").awaitTermination()
    landed = late.pulled(spark, f"{zone}/out", late=False).withColumn("reason", F.lit(None).cast("string"))
    rows = landed.unionByName(late.pulled(spark, f"{zone}/out", late=True))
    return rows.select("event_id", "feed", F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("step").cast("bigint").alias("step"), "reason")


def late_feed_marks(spark, d):
    """How far each feed has landed after the three batches."""
    zone = scratch_path(spark, "marks")
    schema = "event_id bigint, feed string, ts timestamp, step int, arrived_at timestamp"
    for step in STEPS:
        arrived = F.lit(f"2024-02-01 0{step}:00:00").cast("timestamp").alias("arrived_at")
        _arrivals(spark, d).filter(F.col("step") == step).select("*", arrived).write.mode("append").parquet(f"{zone}/in")
        stream = spark.readStream.schema(schema).parquet(f"{zone}/in")
        late.pull_stream(stream, "feed", "ts", ["event_id"], "arrived_at", f"{zone}/out").awaitTermination()
    return late.feed_marks(spark, f"{zone}/out").select("feed", F.col("mark").cast("timestamp_ntz").alias("mark"))


def _changes(spark, d):
    """Changes of each user's record, by events; every fifth deletes."""
    return views.table(spark, d, "events").select(
        F.col("user_id").alias("pk"), F.col("event_id").alias("seq"), F.when(F.col("event_id") % 5 == 0, "delete").otherwise("put").alias("op"),
        F.col("event_type").alias("kind"), F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def upsert_stateful(spark, d):
    """Four batches that each hold events of all times, so that older changes come after newer ones."""
    zone = scratch_path(spark, "keyed")
    changes = _changes(spark, d)
    for step in (2, 0, 3, 1):
        changes.filter(F.col("seq") % 4 == step).write.mode("append").parquet(f"{zone}/in")
        stream = spark.readStream.schema(changes.schema).parquet(f"{zone}/in")
        keyed_table.keep_table(stream, ["pk"], "seq", f"{zone}/table").awaitTermination()
    return keyed_table.kept_table(spark, f"{zone}/table")


def star_published(spark, d):
    """The star loaded as one version; a second load fails in its last table, and the fact is read."""
    zone, root = scratch_path(spark, "loading"), scratch_path(spark, "published")
    sinks.append_parquet(views.event_stats(spark, d), f"{zone}/event_stats")
    sinks.append_parquet(views.visitor_stats(spark, d), f"{zone}/visitor_stats")
    sinks.truncate_load(views.media_show(spark, d), f"{zone}/media_show")
    jobs.publish_star(spark, zone, root)
    tables = jobs.star_frames(spark, zone)
    fact = tables["fact_media_engagement"]
    broken = F.when(F.col("media_id") % 50 == 0, F.raise_error(F.lit("the source is gone")).cast("bigint")).otherwise(F.col("media_id"))
    tables = {"dim_media": tables["dim_media"].limit(1), "fact_media_engagement": fact.withColumn("media_id", broken)}
    try:
        versions.publish(tables, root)
    except Exception as error:  # the planted one only
        if "the source is gone" not in str(error):
            raise
    return _rounded(versions.current(spark, root, "fact_media_engagement"))


QUERIES = {
    "late_three_batches": late_three_batches,
    "late_feed_marks": late_feed_marks,
    "upsert_stateful": upsert_stateful,
    "star_published": star_published,
}

SQL = {
    "late_three_batches": f"""WITH {_ARRIVALS}
SELECT event_id, feed, ts, CAST(step AS BIGINT) AS step, reason FROM (FROM s1 UNION ALL FROM s2 UNION ALL FROM s3)""",
    "late_feed_marks": f"""WITH {_ARRIVALS}
SELECT feed, max(ts) AS mark FROM (FROM s1 UNION ALL FROM s2 UNION ALL FROM s3) WHERE reason IS NULL GROUP BY feed""",
    "upsert_stateful": """SELECT user_id AS pk, event_id AS seq, event_type AS kind, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) WHERE event_id % 5 <> 0""",
    "star_published": STAR_SQL["fact_media_engagement"],
}
