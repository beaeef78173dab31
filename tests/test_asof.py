"""Nearest events by a merge against a plain search."""

import random
from bisect import bisect_left, bisect_right
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from viewloom.operators import asof

START = datetime(2024, 1, 1)


def plain(times, events, inclusive):
    by_key = {}
    for k, e in events:
        by_key.setdefault(k, []).append(e)
    out = []
    for row in times:
        k, t = row[1], row[2]
        found = sorted(e for e in by_key.get(k, []) if e is not None)
        if k is None or t is None:
            out.append((*row, None, None))
            continue
        i = (bisect_right if inclusive else bisect_left)(found, t) - 1
        j = (bisect_left if inclusive else bisect_right)(found, t)
        out.append((*row, found[i] if i >= 0 else None, found[j] if j < len(found) else None))
    return sorted(out, key=lambda r: [str(v) for v in r])


@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("keys, ranges", [(1, 7), (3, 5), (40, 4)])
def test_nearest_equals_a_search(spark, keys, ranges, inclusive):
    """Also where one key lies over many ranges, some without events."""
    rnd = random.Random(keys)
    when = lambda: START + timedelta(minutes=rnd.randrange(500))
    key = lambda: rnd.choice([f"k{rnd.randrange(keys)}", "hot"])
    times = [(i, key(), when()) for i in range(400)] + [(1000, None, when()), (1001, "hot", None), (1002, "unknown", when())]
    events = [(key(), when()) for _ in range(60)] + [(None, when()), ("hot", None), ("only events", when())]
    events += [("hot", START - timedelta(days=1)), ("hot", START - timedelta(days=1))]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(times, "part int, key string, before timestamp_ntz")
        got = asof.nearest(df.toDF("i", "key", "t x"), spark.createDataFrame(events, "key string, e timestamp_ntz"), "key", "t x", "e", inclusive)
        assert rows(got) == plain(times, events, inclusive)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("piece", [1, 17])
def test_a_range_is_merged_in_pieces(spark, monkeypatch, piece):
    """A worker holds no whole range: batches of a few rows are given out as they come."""
    rnd = random.Random(piece)
    when = lambda: START + timedelta(minutes=rnd.randrange(90))
    times = [(i, f"k{rnd.randrange(3)}", when()) for i in range(300)]
    events = [(f"k{rnd.randrange(3)}", when()) for _ in range(80)]
    monkeypatch.setattr(asof, "PIECE", piece)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        for inclusive in (False, True):
            got = asof.nearest(spark.createDataFrame(times, "i int, key string, t timestamp_ntz"), spark.createDataFrame(events, "key string, e timestamp_ntz"), "key", "t", "e", inclusive)
            assert rows(got) == plain(times, events, inclusive)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_sides(spark):
    times = spark.createDataFrame([(1, START)], "k int, t timestamp_ntz")
    events = spark.createDataFrame([(1, START + timedelta(hours=1))], "k int, e timestamp_ntz")
    assert rows(asof.nearest(times, events.limit(0), "k", "t", "e")) == [(1, START, None, None)]
    assert rows(asof.nearest(times.limit(0), events, "k", "t", "e")) == []
    plan = asof.nearest(times, events, "k", "t", "e").select(F.count(F.lit(1)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") <= 2  # over the borders only
