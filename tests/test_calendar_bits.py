"""Counts and n-th occurrences from day bitmaps against expanded rules."""

import random
from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from viewloom.operators import calendar_bits as bits
from viewloom.operators import recurrence as rec

KIND = (
    "rule_id int, freq string, dtstart timestamp_ntz, until timestamp_ntz, count int, interval int, wkst int, bymonth array<int>, bymonthday array<int>, "
    "byyearday array<int>, byweekno array<int>, byweekday array<struct<wd:int,n:int>>, byeaster array<int>, byhour array<int>, byminute array<int>"
)


def random_rules(rnd, n, counted):
    some = lambda p, values, most=3: rnd.sample(values, rnd.randint(1, most)) if rnd.random() < p else None
    out = []
    for i in range(n):
        freq = rnd.choice(["DAILY", "weekly", "MONTHLY", "YEARLY"])
        start = datetime(2020, 1, 1) + timedelta(days=rnd.randrange(900), hours=rnd.randrange(24), minutes=rnd.choice([0, 30]))
        until = start + timedelta(days=rnd.choice([0, 3, 40, 400, 1500]), hours=rnd.randrange(-5, 20))
        weekdays = some(0.35, [(w, k) for w in range(7) for k in (None, None, 1, 2, -1, -2, 5, 20, 0)])
        out.append((
            i, freq, start, None if counted else until, rnd.choice([1, 3, 25]) if counted else None, rnd.choice([None, 1, 2, 3]), rnd.choice([None, 0, 6]),
            some(0.3, list(range(1, 13))), some(0.3, [1, 2, 15, 30, 31, -1, -31]), some(0.1, [1, 60, 100, 366, -1, -200]) if freq == "YEARLY" else None,
            some(0.1, [1, 20, 53, -1]) if freq == "YEARLY" else None, weekdays, some(0.1, [0, -2, 49]) if freq == "YEARLY" else None,
            some(0.3, [0, 9, 17, 23]), some(0.2, [0, 15, 45]),
        ))
    return out


def test_counts_and_ranks_equal_the_expansion(spark):
    rules = spark.createDataFrame(random_rules(random.Random(25), 60, False), KIND)
    found = {}
    for r in rec.expand(rules.drop("count"), list(rec.DAY_FREQS)).collect():
        found.setdefault(r.rule_id, []).append(r.occurrence)
    counted = {r.rule_id: r.occurrences for r in bits.count_by_bits(rules).collect()}
    assert counted == {i: len(found.get(i, [])) for i in range(60)}
    assert sum(counted.values()) > 1000
    got = {r.rule_id: r.occurrence for r in bits.nth_by_bits(rules, F.col("rule_id") % 9 + 1).collect()}
    assert got == {i: sorted(o)[i % 9] for i, o in found.items() if len(o) > i % 9}


def test_counts_without_an_end(spark):
    """The last of a counted rule, found by adding months, is that of the rule with an end far off."""
    rules = spark.createDataFrame(random_rules(random.Random(27), 12, True), KIND)
    ended = rules.withColumn("until", F.lit("2060-01-01").cast("timestamp_ntz"))
    rules = rules.filter("byyearday IS NULL AND byweekno IS NULL AND byeaster IS NULL AND (bymonthday IS NULL OR byweekday IS NULL)")
    ended = ended.join(rules.select("rule_id"), "rule_id")
    last = lambda df: {r.rule_id: r.occurrence for r in bits.nth_by_bits(df, F.col("count")).collect()}
    want = last(ended)
    assert last(rules) == want and len(want) > 3


def test_rules_that_rarely_or_never_fire(spark):
    start = datetime(2021, 5, 1)
    leap = (1, "YEARLY", start, None, 3, None, None, [2], [29], None, None, None, None, None, None)
    backwards = (3, "DAILY", start, start - timedelta(days=1), None, None, None, *[None] * 8)
    df = spark.createDataFrame([leap, backwards], KIND)
    assert rows(bits.count_by_bits(df)) == [(1, 3), (3, 0)]
    assert rows(bits.nth_by_bits(df, F.lit(3))) == [(1, datetime(2032, 2, 29))]


def test_no_occurrences_in_the_plan(spark):
    rules = spark.createDataFrame(random_rules(random.Random(1), 3, False), KIND)
    plan = bits.count_by_bits(rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1  # the months
