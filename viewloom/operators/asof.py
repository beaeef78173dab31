"""The nearest events around asked times, by one merge.

Times and events are dealt together by ranges of (key, time), so each row is shuffled once and a key that
is asked often, or has many events, is split over many tasks. A task sees its rows in order, a piece of
bounded length at a time, and gives each time the events around it; where a key crosses the border of a
piece, the nearest event of the pieces before or after is filled in from a table of at most two rows per
piece. So a worker's memory does not follow the size of a range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.session import scratch_path


#: Rows a worker looks at together; rows of one key and time stay together whatever their number.
PIECE = 200_000


def _merge(inclusive: bool, payload: list[str], size: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """The rows in pieces that end where a key and time does."""
        held, n, enough = [], 0, size
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < enough:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            same = [pc.equal(rows.column(c), rows.column(c)[n - 1]) for c in ("key", "at")]
            cut = n - pc.sum(pc.and_(*same)).as_py()
            if cut:
                yield rows.slice(0, cut)
                rows = rows.slice(cut)
            held, n = rows.combine_chunks().to_batches(), rows.num_rows
            enough = max(size, 2 * n)  # many rows of one time are not put together over and over
        if n:
            yield pa.Table.from_batches(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        for number, rows in enumerate(pieces(b for b in batches if b.num_rows)):
            yield from around(rows.combine_chunks(), (TaskContext.get().partitionId() << 32) + number)

    def around(rows: pa.Table, part: int) -> Iterator[pa.RecordBatch]:
        n, at = rows.num_rows, rows.column("at").combine_chunks()
        key = rows.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
        time, event = at.cast(pa.int64()).to_numpy(), rows.column("event").combine_chunks().to_numpy(zero_copy_only=False)
        place = np.arange(n)
        new_key = np.ones(n, bool)
        new_key[1:] = key[1:] != key[:-1]
        new_time = new_key.copy()
        new_time[1:] |= time[1:] != time[:-1]
        # For each row the first and one past the last row of its key and time, and of its key.
        begins = np.flatnonzero(new_time)
        group = np.cumsum(new_time) - 1
        first, past = begins[group], np.append(begins[1:], n)[group]
        keys = np.flatnonzero(new_key)
        of_key = np.cumsum(new_key) - 1
        low, high = keys[of_key], np.append(keys[1:], n)[of_key]
        last_event = np.maximum.accumulate(np.where(event, place, -1))  # at or before each row
        next_event = np.minimum.accumulate(np.where(event, place, n)[::-1])[::-1]  # at or after each row
        upto = np.concatenate([[-1], last_event])[past if inclusive else first]
        since = np.append(next_event, n)[first if inclusive else past]
        ask = np.flatnonzero(~event)
        found = []
        for index, known in ((upto, upto >= low), (since, since < high)):
            chosen = np.where(known, index, -1)[ask]
            found.append(at.take(pa.array(chosen, mask=chosen < 0)))
        asked = rows.take(pa.array(ask)).select([*payload, "key"])
        names = [*payload, "key", "before", "after", "part", "border"]
        # The events at the edges of the first and the last key, for the neighbours.
        edge = np.unique([low[0], low[-1]])
        a, b = next_event[edge], last_event[high[edge] - 1]
        edges = [at.take(pa.array(np.where(ok, i, 0), mask=~ok)) for i, ok in ((a, a < high[edge]), (b, b >= edge))]
        empty = [pa.nulls(len(edge), rows.schema.field(c).type) for c in payload]
        table = pa.table([*asked.columns, *found, pa.array(np.full(len(ask), part, np.int64)), pa.array(np.zeros(len(ask), bool))], names=names)
        border = pa.table([*empty, rows.column("key").take(pa.array(edge)), *edges, pa.array(np.full(len(edge), part, np.int64)), pa.array(np.ones(len(edge), bool))], names=names)
        yield from border.combine_chunks().to_batches()
        yield from table.combine_chunks().to_batches(max_chunksize=50_000)

    return merge


def nearest(times: DataFrame, events: DataFrame, key: str, at: str, event: str, inclusive: bool = False) -> DataFrame:
    """``times`` with ``before`` and ``after``: the last event of the row's key before its time and the
    first one after it; ``inclusive`` also takes an event at the time itself. Null where there is none, or
    where the key or the time is null. Events may repeat; times stay one row each."""
    spark, columns = times.sparkSession, times.columns
    payload = [f"c{i}" for i in range(len(columns))]
    kinds = {name: times.schema[c].dataType.simpleString() for name, c in zip(payload, columns)}
    key_type, at_type = times.schema[key].dataType.simpleString(), times.schema[at].dataType.simpleString()
    asked = times.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(columns, payload)], F.col(f"`{key}`").alias("key"), F.col(f"`{at}`").alias("at"), F.lit(False).alias("event"))
    given = events.select(
        *[F.lit(None).cast(kinds[p]).alias(p) for p in payload], F.col(f"`{key}`").cast(key_type).alias("key"), F.col(f"`{event}`").cast(at_type).alias("at"), F.lit(True).alias("event")
    )
    whole = F.col("key").isNotNull() & F.col("at").isNotNull()
    both = asked.unionByName(given).filter(whole)
    dealt = both.repartitionByRange("key", "at").sortWithinPartitions("key", "at")
    schema = ", ".join([*[f"{p} {kinds[p]}" for p in payload], f"key {key_type}, before {at_type}, after {at_type}, part bigint, border boolean"])
    # Written, as the borders are needed before the rows can be given out.
    folder = scratch_path(spark, "nearest")
    dealt.mapInArrow(_merge(inclusive, payload, PIECE), schema).write.parquet(folder)
    merged = spark.read.schema(schema).parquet(folder)
    edges = merged.filter("border").select("part", "key", F.col("before").alias("first"), F.col("after").alias("last"))
    by_key = Window.partitionBy("key").orderBy("part")
    carried = edges.select(
        F.col("part").alias("of_part"),
        F.col("key").alias("of_key"),
        F.max("last").over(by_key.rowsBetween(Window.unboundedPreceding, -1)).alias("from_left"),
        F.min("first").over(by_key.rowsBetween(1, Window.unboundedFollowing)).alias("from_right"),
    ).filter("from_left IS NOT NULL OR from_right IS NOT NULL")
    # At most two rows per piece.
    filled = merged.filter("NOT border").join(F.broadcast(carried), (F.col("part") == F.col("of_part")) & (F.col("key") == F.col("of_key")), "left")
    out = [F.col(p).alias(c) for p, c in zip(payload, columns)]
    result = filled.select(*out, F.coalesce("before", "from_left").alias("before"), F.coalesce("after", "from_right").alias("after"))
    nothing: Column = F.lit(None).cast(at_type)
    return result.unionByName(asked.filter(~whole).select(*out, nothing.alias("before"), nothing.alias("after")))
