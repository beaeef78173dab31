"""Star-schema queries over the supplied tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewloom.operators import star
from viewloom.plans import rollups, views
from viewloom.plans.views import (
    CHANNEL_MAP,
    EVENT_STATS,
    MEDIA_SHOW,
    MEDIA_SHOW_SNAPSHOTS,
    VISITOR_STATS,
    VISITOR_STATS_HISTORY,
)


def filter_target_media(spark, d):
    targets = views.channel_map(spark, d).select("media_id")
    events = views.event_stats(spark, d)
    return star.keep_targets(events, targets).select(
        "media_id", "visitor_key", "received_at", "percent_viewed"
    )


def media_channel(spark, d):
    media = star.media_view(views.media_show(spark, d)).select("media_id", "title")
    return star.with_channel(media, views.channel_map(spark, d))


def media_channel_literal(spark, d):
    media = star.media_view(views.media_show(spark, d)).select("media_id", "title")
    return star.with_channel(media, {7: "YouTube", 42: "YouTube"})


def play_rate(spark, d):
    """Loads are counted over urgent orders only, so some are 0."""
    per_customer = (
        views.table(spark, d, "orders")
        .groupBy(F.col("o_custkey").alias("visitor_key"))
        .agg(
            F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("load_count"),
            F.count_if(
                (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
            ).alias("play_count"),
        )
    )
    everyone = views.table(spark, d, "customer").select(F.col("c_custkey").alias("visitor_key"))
    return everyone.join(per_customer, "visitor_key", "left").withColumn(
        "play_rate", F.round(star.play_rate(), 9)
    )


def total_watch_time(spark, d):
    events = star.event_view(views.event_stats(spark, d))
    media = star.media_view(views.media_show(spark, d)).select("media_id", "duration")
    return events.join(media, "media_id", "left").select(
        "media_id",
        "visitor_key",
        "date",
        F.round(star.total_watch_time(), 9).alias("total_watch_time"),
    )


def join_media_events(spark, d):
    media = star.media_view(views.media_show(spark, d))
    events = star.event_view(views.event_stats(spark, d))
    return media.join(events, "media_id", "left").select(
        "media_id", "title", "url", "visitor_key", "date"
    )


def join_visitor_events(spark, d):
    events = star.keep_targets(
        views.event_stats(spark, d), views.channel_map(spark, d).select("media_id")
    )
    return (
        views.visitor_stats(spark, d)
        .join(events, "visitor_key")
        .select("visitor_key", "media_id", "ip", "country", "load_count", "received_at")
    )


def dedup_full_row(spark, d):
    events = views.event_stats(spark, d).select("media_id", "media_url", "visitor_key", "ip", "country")
    return events.dropDuplicates()


def dim_media(spark, d):
    return star.dim_media(
        views.media_show(spark, d), views.event_stats(spark, d), channels=views.channel_map(spark, d)
    )


def dim_media_parity(spark, d):
    return star.dim_media(
        views.media_show_snapshots(spark, d),
        views.event_stats(spark, d),
        targets=views.channel_map(spark, d).select("media_id"),
        channels={7: "YouTube"},
        mode="parity",
    )


def _repeated_media(spark, d):
    """Media without snapshot days, every third size listed twice with another duration."""
    base = views.media_show(spark, d)
    return base.unionByName(base.filter(F.col("duration") % 3 == 0).withColumn("duration", F.col("duration") + 10))


def _repeated_channels(spark, d):
    channels = views.channel_map(spark, d)
    return channels.unionByName(channels.withColumn("channel", F.lit("Vimeo"))).unionByName(channels)


def dim_media_repeats(spark, d):
    return star.dim_media(
        _repeated_media(spark, d), views.event_stats(spark, d), channels=_repeated_channels(spark, d)
    )


def fact_repeats(spark, d):
    """Events of nobody's interest (0 % viewed) must not double with the media rows either."""
    events = views.event_stats(spark, d).withColumn(
        "percent_viewed", F.when(F.col("visitor_key") % 2 == 0, 0.0).otherwise(F.col("percent_viewed"))
    )
    return _rounded(star.fact_media_engagement(events, _repeated_media(spark, d), views.visitor_stats(spark, d)))


def dim_visitor(spark, d):
    return star.dim_visitor(views.visitor_stats(spark, d), views.event_stats(spark, d))


def _rounded(fact):
    return fact.withColumns(
        {c: F.round(c, 9) for c in ("play_rate", "total_watch_time", "watched_percent")}
    )


def fact_media_engagement(spark, d):
    return _rounded(
        star.fact_media_engagement(
            views.event_stats(spark, d), views.media_show(spark, d), views.visitor_stats(spark, d)
        )
    )


def fact_media_engagement_latest(spark, d):
    return _rounded(
        star.fact_media_engagement(
            views.event_stats(spark, d),
            views.media_show_snapshots(spark, d),
            views.visitor_stats_history(spark, d),
        )
    )


def fact_media_engagement_parity(spark, d):
    return _rounded(
        star.fact_media_engagement(
            views.event_stats(spark, d),
            views.media_show_snapshots(spark, d),
            views.visitor_stats_history(spark, d),
            mode="parity",
        )
    )


def engagement_by_channel_day(spark, d):
    return rollups.by_channel_day(fact_media_engagement(spark, d), views.channel_map(spark, d))


def engagement_top_visitors(spark, d):
    return rollups.top_visitors(fact_media_engagement(spark, d), 10)


QUERIES = {
    "filter_target_media": filter_target_media,
    "media_channel": media_channel,
    "media_channel_literal": media_channel_literal,
    "play_rate": play_rate,
    "total_watch_time": total_watch_time,
    "join_media_events": join_media_events,
    "join_visitor_events": join_visitor_events,
    "dedup_full_row": dedup_full_row,
    "dim_media": dim_media,
    "dim_media_parity": dim_media_parity,
    "dim_media_repeats": dim_media_repeats,
    "fact_repeats": fact_repeats,
    "dim_visitor": dim_visitor,
    "fact_media_engagement": fact_media_engagement,
    "fact_media_engagement_latest": fact_media_engagement_latest,
    "fact_media_engagement_parity": fact_media_engagement_parity,
    "engagement_by_channel_day": engagement_by_channel_day,
    "engagement_top_visitors": engagement_top_visitors,
}

_RATE = "CASE WHEN load_count > 0 THEN CAST(play_count AS DOUBLE) / load_count ELSE 0.0 END"


def _fact(media: str, visitors: str) -> str:
    return f"""
SELECT DISTINCT e.media_id, e.visitor_key AS visitor_id, e.received_at AS date, v.play_count,
       v.load_count, round({_RATE}, 9) AS play_rate,
       round(e.percent_viewed * m.duration, 9) AS total_watch_time,
       round(e.percent_viewed, 9) AS watched_percent
FROM event_stats e LEFT JOIN {media} m ON m.hashed_id = e.media_id
LEFT JOIN {visitors} v ON v.visitor_key = e.visitor_key"""


_FACT_WITH = f"WITH {EVENT_STATS}, {MEDIA_SHOW}, {VISITOR_STATS}"

SQL = {
    "filter_target_media": f"""WITH {EVENT_STATS}, {CHANNEL_MAP}
SELECT media_id, visitor_key, received_at, percent_viewed FROM event_stats
WHERE media_id IN (SELECT media_id FROM channel_map)""",
    "media_channel": f"""WITH {MEDIA_SHOW}, {CHANNEL_MAP}
SELECT m.hashed_id AS media_id, m.name AS title, coalesce(c.channel, 'Facebook') AS channel
FROM media_show m LEFT JOIN channel_map c ON c.media_id = m.hashed_id""",
    "media_channel_literal": f"""WITH {MEDIA_SHOW}
SELECT hashed_id AS media_id, name AS title,
       CASE WHEN hashed_id IN (7, 42) THEN 'YouTube' ELSE 'Facebook' END AS channel FROM media_show""",
    "play_rate": f"""WITH p AS (
  SELECT o_custkey AS visitor_key, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS load_count,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') AS play_count
  FROM orders GROUP BY o_custkey)
SELECT c_custkey AS visitor_key, load_count, play_count, round({_RATE}, 9) AS play_rate
FROM customer LEFT JOIN p ON p.visitor_key = c_custkey""",
    "total_watch_time": f"""WITH {EVENT_STATS}, {MEDIA_SHOW}
SELECT e.media_id, e.visitor_key, e.received_at AS date,
       round(e.percent_viewed * m.duration, 9) AS total_watch_time
FROM event_stats e LEFT JOIN media_show m ON m.hashed_id = e.media_id""",
    "join_media_events": f"""WITH {EVENT_STATS}, {MEDIA_SHOW}
SELECT m.hashed_id AS media_id, m.name AS title, e.media_url AS url, e.visitor_key, e.received_at AS date
FROM media_show m LEFT JOIN event_stats e ON e.media_id = m.hashed_id""",
    "join_visitor_events": f"""WITH {EVENT_STATS}, {VISITOR_STATS}, {CHANNEL_MAP}
SELECT v.visitor_key, e.media_id, e.ip, e.country, v.load_count, e.received_at
FROM visitor_stats v LEFT JOIN event_stats e ON e.visitor_key = v.visitor_key
WHERE e.media_id IN (SELECT media_id FROM channel_map)""",
    "dedup_full_row": f"""WITH {EVENT_STATS}
SELECT DISTINCT media_id, media_url, visitor_key, ip, country FROM event_stats""",
    "dim_media": f"""WITH {EVENT_STATS}, {MEDIA_SHOW}, {CHANNEL_MAP}
SELECT DISTINCT m.hashed_id AS media_id, m.name AS title, e.media_url AS url, m.created AS created_at,
       coalesce(c.channel, 'Facebook') AS channel
FROM media_show m LEFT JOIN event_stats e ON e.media_id = m.hashed_id
LEFT JOIN channel_map c ON c.media_id = m.hashed_id""",
    "dim_media_parity": f"""WITH {EVENT_STATS}, {MEDIA_SHOW_SNAPSHOTS}, {CHANNEL_MAP}
SELECT DISTINCT m.hashed_id AS media_id, m.name AS title, e.media_url AS url, m.created AS created_at,
       CASE WHEN m.hashed_id = 7 THEN 'YouTube' ELSE 'Facebook' END AS channel
FROM media_show_snapshots m LEFT JOIN event_stats e ON e.media_id = m.hashed_id
WHERE m.hashed_id IN (SELECT media_id FROM channel_map)""",
    "dim_visitor": f"""WITH {EVENT_STATS}, {VISITOR_STATS}
SELECT DISTINCT v.visitor_key AS visitor_id, e.ip AS ip_address, e.country
FROM visitor_stats v LEFT JOIN event_stats e ON e.visitor_key = v.visitor_key
WHERE e.media_id IS NOT NULL""",
    "fact_media_engagement": _FACT_WITH + _fact("media_show", "visitor_stats"),
    "fact_media_engagement_latest": f"""WITH {EVENT_STATS}, {MEDIA_SHOW_SNAPSHOTS}, {VISITOR_STATS_HISTORY},
last_media AS (SELECT * FROM media_show_snapshots WHERE snapshot_date = DATE '2024-02-02'),
last_visitor AS (
  SELECT * FROM visitor_stats_history QUALIFY row_number() OVER (
    PARTITION BY visitor_key ORDER BY created_at DESC, load_count DESC, play_count DESC) = 1)"""
    + _fact("last_media", "last_visitor"),
    "fact_media_engagement_parity": f"WITH {EVENT_STATS}, {MEDIA_SHOW_SNAPSHOTS}, {VISITOR_STATS_HISTORY}"
    + _fact("media_show_snapshots", "visitor_stats_history"),
    "engagement_by_channel_day": f"""{_FACT_WITH}, {CHANNEL_MAP}, fact AS ({_fact("media_show", "visitor_stats")})
SELECT coalesce(c.channel, 'Facebook') AS channel, CAST(f.date AS DATE) AS day,
       CAST(grouping(coalesce(c.channel, 'Facebook')) * 2 + grouping(CAST(f.date AS DATE)) AS BIGINT) AS level,
       count(*) AS views, count(DISTINCT visitor_id) AS visitors,
       round(sum(total_watch_time), 6) AS watch_time, round(avg(play_rate), 6) AS avg_play_rate
FROM fact f LEFT JOIN channel_map c ON c.media_id = f.media_id
GROUP BY CUBE (coalesce(c.channel, 'Facebook'), CAST(f.date AS DATE))""",
    "engagement_top_visitors": f"""{_FACT_WITH}, fact AS ({_fact("media_show", "visitor_stats")})
SELECT visitor_id, round(sum(total_watch_time), 6) AS watch_time, count(*) AS views
FROM fact GROUP BY visitor_id ORDER BY watch_time DESC NULLS LAST, visitor_id LIMIT 10""",
    "dim_media_repeats": f"""WITH {EVENT_STATS}, {MEDIA_SHOW}, {CHANNEL_MAP}
SELECT DISTINCT m.hashed_id AS media_id, m.name AS title, e.media_url AS url, m.created AS created_at,
       CASE WHEN c.channel IS NULL THEN 'Facebook' ELSE 'Vimeo' END AS channel
FROM media_show m LEFT JOIN event_stats e ON e.media_id = m.hashed_id
LEFT JOIN channel_map c ON c.media_id = m.hashed_id""",
    "fact_repeats": f"""WITH {EVENT_STATS.replace("event_stats AS", "raw_events AS")}, {MEDIA_SHOW}, {VISITOR_STATS},
event_stats AS (
  SELECT * REPLACE (CASE WHEN visitor_key % 2 = 0 THEN 0.0 ELSE percent_viewed END AS percent_viewed) FROM raw_events),
one_media AS (
  SELECT * REPLACE (CASE WHEN duration % 3 = 0 THEN duration + 10 ELSE duration END AS duration) FROM media_show)"""
    + _fact("one_media", "visitor_stats"),
}
