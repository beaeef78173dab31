"""The media star schema: two dimensions and the engagement fact.

``mode="latest"`` keeps one row per media and per visitor (the newest snapshot)
before joining; ``mode="parity"`` keeps every snapshot row and lets the final
distinct merge what is equal.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.operators.ordered import latest_per_key

MEDIA_NAMES = {"hashed_id": "media_id", "name": "title", "created": "created_at"}
EVENT_NAMES = {"media_url": "url", "received_at": "date", "percent_viewed": "watched_percent"}
VISITOR_NAMES = {"visitor_key": "visitor_id", "ip": "ip_address"}

DIM_MEDIA = ["media_id", "title", "url", "created_at", "channel"]
DIM_VISITOR = ["visitor_id", "ip_address", "country"]
FACT = [
    "media_id",
    "visitor_id",
    "date",
    "play_count",
    "load_count",
    "play_rate",
    "total_watch_time",
    "watched_percent",
]

# Longest id list that is kept as an IN predicate; longer ones become a semi join.
LONGEST_IN_LIST = 500

Targets = Iterable | DataFrame | None


def media_view(media_show: DataFrame) -> DataFrame:
    return media_show.withColumnsRenamed(MEDIA_NAMES)


def event_view(event_stats: DataFrame) -> DataFrame:
    return event_stats.withColumnsRenamed(EVENT_NAMES)


def keep_targets(df: DataFrame, targets: Targets, column: str = "media_id") -> DataFrame:
    """Membership filter. ``None`` keeps all, a short list is pushed to the scan
    as an IN predicate, a table or a long list becomes a left-semi join."""
    if targets is None:
        return df
    if not isinstance(targets, DataFrame):
        ids = list(targets)
        if len(ids) <= LONGEST_IN_LIST:
            return df.filter(F.col(column).isin(ids))
        kind = df.schema[column].dataType.simpleString()
        targets = df.sparkSession.createDataFrame([(i,) for i in ids], f"{column} {kind}")
    wanted = targets.select(F.col(targets.columns[0]).alias(column)).distinct()
    return df.join(wanted, column, "left_semi")


def with_channel(
    df: DataFrame, channels: Mapping | DataFrame | None, default: str = "Facebook"
) -> DataFrame:
    """Label each media with its channel; unlisted media get ``default``."""
    if isinstance(channels, DataFrame):
        # A media listed twice has the label that sorts first, and stays one row.
        labels = channels.groupBy("media_id").agg(F.min("channel").alias("channel"))
        return df.join(labels, "media_id", "left").fillna(default, ["channel"])
    label: Column | None = None
    for media_id, name in (channels or {}).items():
        hit = F.col("media_id") == F.lit(media_id)
        label = F.when(hit, F.lit(name)) if label is None else label.when(hit, F.lit(name))
    return df.withColumn("channel", F.lit(default) if label is None else label.otherwise(default))


def play_rate(play_count: str = "play_count", load_count: str = "load_count") -> Column:
    """Plays per load; 0 when there were no loads or the count is unknown."""
    return F.when(F.col(load_count) > 0, F.col(play_count) / F.col(load_count)).otherwise(F.lit(0.0))


def total_watch_time(percent: str = "watched_percent", duration: str = "duration") -> Column:
    return F.col(percent) * F.col(duration)


def latest_media(media_show: DataFrame) -> DataFrame:
    """One row per media: the newest snapshot, then the newest creation, then the
    largest of the other columns."""
    key = "hashed_id" if "hashed_id" in media_show.columns else "media_id"
    order = [c for c in ("snapshot_date", "created", "created_at") if c in media_show.columns]
    return latest_per_key(media_show, [key], order)


def latest_visitors(visitor_stats: DataFrame) -> DataFrame:
    order = [c for c in ("created_at",) if c in visitor_stats.columns]
    return latest_per_key(visitor_stats, ["visitor_key"], order)


def _sides(wanted: list[str], *tables: DataFrame) -> list[list[str]]:
    """Which table supplies which column; every column must have one owner."""
    owned: list[list[str]] = [[] for _ in tables]
    for column in wanted:
        holders = [i for i, t in enumerate(tables) if column in t.columns]
        if len(holders) != 1:
            raise ValueError(f"column {column!r} must come from exactly one table, found {len(holders)}")
        owned[holders[0]].append(column)
    return owned


def dim_media(
    media_show: DataFrame,
    event_stats: DataFrame,
    targets: Targets = None,
    channels: Mapping | DataFrame | None = None,
    mode: str = "latest",
) -> DataFrame:
    """Media with the urls seen in events; media without events keep a null url.

    Events shrink to distinct (media, url) before the join, so a media that holds
    most events is one row per url by then.
    """
    media = media_view(latest_media(media_show) if mode == "latest" else media_show)
    media = keep_targets(media.select("media_id", "title", "created_at"), targets).distinct()
    urls = keep_targets(event_view(event_stats).select("media_id", "url"), targets).distinct()
    labelled = with_channel(media, channels)
    # Both sides are distinct and their columns are all kept, so the result is too.
    return labelled.join(urls, "media_id", "left").select(*DIM_MEDIA)


def dim_visitor(
    visitor_stats: DataFrame, event_stats: DataFrame, targets: Targets = None
) -> DataFrame:
    """Visitors that met a target media. The filter on the event side makes the
    left join an inner one; columns found on the events need a semi join only."""
    events = keep_targets(event_stats.filter(F.col("media_id").isNotNull()), targets)
    from_events, from_visitors = _sides(["ip", "country"], event_stats, visitor_stats)
    seen = events.select("visitor_key", *from_events).distinct()
    known = visitor_stats.select("visitor_key", *from_visitors).distinct()
    how = "inner" if from_visitors else "left_semi"
    return seen.join(known, "visitor_key", how).withColumnsRenamed(VISITOR_NAMES).select(*DIM_VISITOR)


def fact_media_engagement(
    event_stats: DataFrame,
    media_show: DataFrame,
    visitor_stats: DataFrame,
    targets: Targets = None,
    mode: str = "latest",
) -> DataFrame:
    """One row per distinct (media, visitor, time, percent) with its measures.

    Each side is pruned and made distinct before its join. In latest mode media
    and visitors are unique by key, so the rows stay distinct and no second
    shuffle over the wide result is needed.
    """
    events = keep_targets(event_view(event_stats), targets)
    media = media_view(latest_media(media_show) if mode == "latest" else media_show)
    visitors = latest_visitors(visitor_stats) if mode == "latest" else visitor_stats
    measures = ["duration", "load_count", "play_count"]
    from_events, from_media, from_visitors = _sides(measures, events, media, visitors)

    facts = events.select("media_id", "visitor_key", "date", "watched_percent", *from_events).distinct()
    media = keep_targets(media.select("media_id", *from_media), targets).distinct()
    visitors = visitors.select("visitor_key", *from_visitors).distinct()
    joined = facts.join(media, "media_id", "left").join(visitors, "visitor_key", "left")
    result = (
        joined.withColumnRenamed("visitor_key", "visitor_id")
        .withColumn("play_rate", play_rate())
        .withColumn("total_watch_time", total_watch_time())
        .select(*FACT)
    )
    unique = mode == "latest" and not from_events
    return result if unique else result.dropDuplicates()
