"""The pipeline's jobs from landed files to star tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from viewloom.operators import star
from viewloom.operators.flatten import flatten_if_nested, flatten_structs
from viewloom.operators.incremental import FULL_LOAD_PAGES, PAGE_SIZE, pull
from viewloom.sources import sinks, state, versions
from viewloom.sources.catalog import read_table


def append_flattened(df: DataFrame, path: str) -> bool:
    """Incremental table: flatten always, append without partitions."""
    return sinks.append_parquet(flatten_structs(df), path)


def snapshot_flattened(df: DataFrame, path: str, run_date: date, replace: bool = True) -> bool:
    """Snapshot table: flatten only when a struct is there, one partition per day."""
    return sinks.write_snapshot(flatten_if_nested(df), path, run_date, replace)


def incremental_pull(
    records: DataFrame,
    feed: list[str],
    ts: str,
    tie: list[str],
    landing: str,
    marks: str,
    run: datetime,
    cap: int | None = PAGE_SIZE * FULL_LOAD_PAGES,
) -> int:
    """One incremental run: load the watermark, keep what is newer (or the first
    ``cap`` records), land it as JSON Lines in a folder of this run, and record the
    newest time. Returns the number of landed records.

    The write observes the newest time it lands, so the watermark never passes a
    record that was not written, even if the source grows meanwhile. If the write
    fails the watermark stays, and the next run with the same ``run`` time replaces
    the run's folder. A run without new records lands nothing.
    """
    spark = records.sparkSession
    wanted = pull(records, feed, ts, tie, state.load_watermark(spark, marks), cap)
    seen = Observation()
    newest = F.max(F.col(ts)).cast("timestamp").alias("newest")
    counted = wanted.observe(seen, F.count(F.lit(1)).alias("rows"), newest)
    counted.write.mode("overwrite").options(**sinks.JSON_LINES).json(f"{landing}/run={run:%Y%m%dT%H%M%S}")
    state.append_watermark(spark, seen.get["newest"], marks)
    return seen.get["rows"]


def star_frames(
    spark: SparkSession,
    source: str,
    targets=None,
    channels: Mapping | DataFrame | None = None,
    mode: str = "latest",
) -> dict[str, DataFrame]:
    """The three star tables from the three loading tables, read whole.

    Each branch reads only its own columns of the event table, so nothing is
    cached: the three pruned scans cost less than storing the event table.
    """
    events = read_table(spark, "event_stats", source)
    media = read_table(spark, "media_show", source)
    visitors = read_table(spark, "visitor_stats", source)
    return {
        "dim_media": star.dim_media(media, events, targets, channels, mode),
        "dim_visitor": star.dim_visitor(visitors, events, targets),
        "fact_media_engagement": star.fact_media_engagement(events, media, visitors, targets, mode),
    }


def build_star(
    spark: SparkSession,
    source: str,
    out: str,
    targets=None,
    channels: Mapping | DataFrame | None = None,
    mode: str = "latest",
) -> None:
    """Replace the three star tables one by one."""
    for name, table in star_frames(spark, source, targets, channels, mode).items():
        sinks.truncate_load(table, f"{out}/{name}")


def publish_star(
    spark: SparkSession,
    source: str,
    root: str,
    targets=None,
    channels: Mapping | DataFrame | None = None,
    mode: str = "latest",
) -> int:
    """Replace the three star tables together: readers of ``versions.current`` see all of one load."""
    return versions.publish(star_frames(spark, source, targets, channels, mode), root)
