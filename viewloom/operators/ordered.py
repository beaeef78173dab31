"""Ordered work over groups of any size.

A plain window over a group sorts the whole group in one task. The helpers here
split each group into blocks, reduce the blocks to one row each, run the window
over those few rows, and join the carried value back to the block's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null being equal to null; the keys of the left side stay."""
    renamed = right.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"_same_{k}"])
    return left.join(renamed, condition, how).drop(*[f"_same_{k}" for k in keys])


def running_sum(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    out: str,
    block: Column,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` from the start of the group up to this row.

    ``block`` must not decrease along ``order`` and must bound the rows of one
    (group, block); the order columns must be unique within a group.
    """
    tagged = df.withColumn("_blk", block).withColumn("_val", value)
    per_block = tagged.groupBy(*keys, "_blk").agg(F.sum("_val").alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_block.select(
        *keys, "_blk", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_carry")
    )
    joined = join_same(tagged, carry, [*keys, "_blk"])
    inside = (
        Window.partitionBy(*keys, "_blk")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return joined.withColumn(out, F.col("_carry") + F.sum("_val").over(inside)).drop(
        "_blk", "_val", "_carry"
    )


def row_position(
    df: DataFrame, keys: list[str], order: list[str], out: str, block: Column
) -> DataFrame:
    """1-based position of each row in its group; see :func:`running_sum`."""
    return running_sum(df, keys, order, F.lit(1).cast("bigint"), out, block)


def newest_per_group(
    df: DataFrame,
    keys: list[str],
    ts: str,
    tie: list[str],
    limit: int,
    salts: int = 64,
) -> DataFrame:
    """The ``limit`` newest rows of each group (ties by ``tie``, ascending). Rows
    without a time are the oldest.

    Three exact steps: an hourly count per group gives the hour that holds the
    last wanted row, older rows are dropped before anything is shuffled whole,
    and what is left is ranked first per salt and then per group.
    """
    hour = F.date_trunc("hour", F.col(ts))
    newer = Window.partitionBy(*keys).orderBy(F.desc("_hour")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    cutoff = (
        df.groupBy(*keys, hour.alias("_hour"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(newer), F.lit(0)))
        .filter(F.col("_before") < limit)
        .groupBy(*keys)
        .agg(F.min("_hour").alias("_from"), F.bool_or(F.col("_hour").isNull()).alias("_all"))
    )
    same_key = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    condition = F.col("b._all") | (F.col(f"a.{ts}") >= F.col("b._from"))
    for part in same_key:
        condition = part & condition
    kept = df.alias("a").join(cutoff.alias("b"), condition, "left_semi")
    ranking = [F.desc(ts), *[F.asc(c) for c in tie]]
    salted = kept.withColumn("_salt", F.pmod(F.xxhash64(ts, *tie), F.lit(salts)))
    by_salt = Window.partitionBy(*keys, "_salt").orderBy(*ranking)
    by_group = Window.partitionBy(*keys).orderBy(*ranking)
    return (
        salted.withColumn("_rank", F.row_number().over(by_salt))
        .filter(F.col("_rank") <= limit)
        .withColumn("_rank", F.row_number().over(by_group))
        .filter(F.col("_rank") <= limit)
        .drop("_salt", "_rank")
    )


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last by ``order``, then by the other columns.

    ``max`` over a struct combines map-side, so a hot key never reaches one task
    row by row.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    plain = [c for c in rest if not _has(df.schema[c].dataType, ("map", "variant"))]
    if len(plain) == len(rest):
        last = F.max(F.struct(*order, *rest)).alias("_last")
    else:  # maps and variants have no order; such columns only follow the others
        last = F.max_by(F.struct(*order, *rest), F.struct(*order, *plain)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*df.columns)


def _has(kind, names: tuple[str, ...]) -> bool:
    return any(name in kind.simpleString() for name in names)
