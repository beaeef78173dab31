from datetime import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from viewloom.operators import recurrence as rec


SCHEMA = (
    "rule_id int, freq string, dtstart timestamp_ntz, interval int, count int, until timestamp_ntz, wkst int, "
    "bymonth array<int>, bymonthday array<int>, byyearday array<int>, byweekno array<int>, byeaster array<int>, "
    "byhour array<int>, byminute array<int>, bysecond array<int>, bysetpos array<int>, "
    "byweekday array<struct<wd:int,n:int>>"
)


def rule(number, freq, start, fields):
    row = {"rule_id": number, "freq": freq, "dtstart": dt.fromisoformat(start), **fields}
    if "until" in row:
        row["until"] = dt.fromisoformat(row["until"])
    if "byweekday" in row:
        row["byweekday"] = [(e, None) if isinstance(e, int) else e for e in row["byweekday"]]
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return tuple(row.get(name) for name in names)


CASES = [
    # month ends are skipped, not clipped
    (("MONTHLY", "2014-12-31", dict(count=4)), ["2014-12-31", "2015-01-31", "2015-03-31", "2015-05-31"]),
    (("YEARLY", "2000-02-29", dict(count=3)), ["2000-02-29", "2004-02-29", "2008-02-29"]),
    (("YEARLY", "1896-02-29", dict(count=3)), ["1896-02-29", "1904-02-29", "1908-02-29"]),
    (("DAILY", "1997-09-02", dict(interval=10, count=3)), ["1997-09-02", "1997-09-12", "1997-09-22"]),
    (("WEEKLY", "1997-09-02", dict(interval=2, until="1997-10-01")), ["1997-09-02", "1997-09-16", "1997-09-30"]),
    # alternate weeks depend on the first day of the week
    (("WEEKLY", "1997-08-05", dict(interval=2, count=4, byweekday=[1, 6], wkst=0)),
     ["1997-08-05", "1997-08-10", "1997-08-19", "1997-08-24"]),
    (("WEEKLY", "1997-08-05", dict(interval=2, count=4, byweekday=[1, 6], wkst=6)),
     ["1997-08-05", "1997-08-17", "1997-08-19", "1997-08-31"]),
    (("MONTHLY", "1997-09-02", dict(count=4, byweekday=[(4, 1), (4, -1)])),
     ["1997-09-05", "1997-09-26", "1997-10-03", "1997-10-31"]),
    (("MONTHLY", "1997-09-02", dict(count=3, bymonthday=[-3])), ["1997-09-28", "1997-10-29", "1997-11-28"]),
    (("YEARLY", "1997-01-01", dict(count=4, byyearday=[1, 100, -1], interval=3)),
     ["1997-01-01", "1997-04-10", "1997-12-31", "2000-01-01"]),
    (("YEARLY", "1997-05-12", dict(count=3, byweekno=[20], byweekday=[0])), ["1997-05-12", "1998-05-11", "1999-05-17"]),
    (("YEARLY", "2008-12-01", dict(until="2011-01-31", byweekno=[53], byweekday=[3, 4])),
     ["2009-12-31", "2010-01-01"]),
    (("YEARLY", "2008-12-20", dict(until="2010-01-31", byweekno=[-1], byweekday=[6])), ["2008-12-28", "2010-01-03"]),
    (("YEARLY", "1997-01-01", dict(count=3, byeaster=[0])), ["1997-03-30", "1998-04-12", "1999-04-04"]),
    (("YEARLY", "2008-01-01", dict(count=2, byeaster=[1])), ["2008-03-24", "2009-04-13"]),
    (("YEARLY", "1996-11-05", dict(interval=4, count=3, bymonth=[11], byweekday=[1], bymonthday=[2, 3, 4, 5, 6, 7, 8])),
     ["1996-11-05", "2000-11-07", "2004-11-02"]),
    (("YEARLY", "1997-01-06", dict(count=3, byweekday=[(0, 20)])), ["1997-05-19", "1998-05-18", "1999-05-17"]),
    (("YEARLY", "1997-01-06", dict(count=2, bymonth=[3], byweekday=[(3, -1)])), ["1997-03-27", "1998-03-26"]),
    (("MONTHLY", "1997-09-29", dict(count=3, byweekday=[0, 1, 2, 3, 4], bysetpos=[-2])),
     ["1997-09-29", "1997-10-30", "1997-11-27"]),
    (("MONTHLY", "1997-09-04", dict(count=3, byweekday=[1, 2, 3], bysetpos=[3])),
     ["1997-09-04", "1997-10-07", "1997-11-06"]),
    # the first week of a weekly rule begins at the start
    (("WEEKLY", "2024-01-03", dict(count=3, byweekday=[0, 2, 4], bysetpos=[1])),
     ["2024-01-03", "2024-01-08", "2024-01-15"]),
    (("DAILY", "1997-09-02 09:00:00", dict(count=4, byhour=[9, 18], byminute=[30])),
     ["1997-09-02 09:30:00", "1997-09-02 18:30:00", "1997-09-03 09:30:00", "1997-09-03 18:30:00"]),
    (("DAILY", "1997-09-02 09:00:00", dict(count=2, byhour=[6, 18], bysetpos=[1])),
     ["1997-09-03 06:00:00", "1997-09-04 06:00:00"]),
    (("HOURLY", "1997-09-02 09:00:00", dict(interval=3, until="1997-09-02 17:00:00")),
     ["1997-09-02 09:00:00", "1997-09-02 12:00:00", "1997-09-02 15:00:00"]),
    (("HOURLY", "1997-09-02 09:00:00", dict(interval=25, count=3)),
     ["1997-09-02 09:00:00", "1997-09-03 10:00:00", "1997-09-04 11:00:00"]),
    (("HOURLY", "1997-09-02 09:10:00", dict(count=3, byminute=[0, 20], bysetpos=[-1])),
     ["1997-09-02 09:20:00", "1997-09-02 10:20:00", "1997-09-02 11:20:00"]),
    (("MINUTELY", "1997-09-02 09:00:00", dict(interval=90, count=3)),
     ["1997-09-02 09:00:00", "1997-09-02 10:30:00", "1997-09-02 12:00:00"]),
    (("MINUTELY", "1997-09-02 23:59:00", dict(count=3, byhour=[0, 23], bymonthday=[2, 4])),
     ["1997-09-02 23:59:00", "1997-09-04", "1997-09-04 00:01:00"]),
    (("SECONDLY", "1997-09-02 23:59:50", dict(interval=7, count=3)),
     ["1997-09-02 23:59:50", "1997-09-02 23:59:57", "1997-09-03 00:00:04"]),
    (("DAILY", "1997-09-02", dict(until="1997-09-10", count=2)), ["1997-09-02", "1997-09-03"]),
    (("DAILY", "1997-09-02", dict(until="1997-09-01")), []),
    (("YEARLY", "9990-01-01", dict(count=50)), [f"{y}-01-01" for y in range(9990, 10000)]),
]


@pytest.fixture(scope="module")
def expanded(spark):
    table = spark.createDataFrame([rule(i, *case) for i, (case, _) in enumerate(CASES)], SCHEMA)
    found = {}
    for r in rec.expand(table).collect():
        found.setdefault(r.rule_id, []).append(r.occurrence)
    return {k: sorted(v) for k, v in found.items()}


@pytest.mark.parametrize("number", range(len(CASES)), ids=[f"{c[0][0]}-{i}" for i, c in enumerate(CASES)])
def test_expansion(expanded, number):
    got = [str(t).replace(" 00:00:00", "") for t in expanded.get(number, [])]
    assert got == CASES[number][1]


def test_mixed_rules_in_one_table(spark):
    df = spark.createDataFrame(
        [("a", "DAILY", dt(2024, 1, 1), 3, None), ("b", "DAILY", dt(2024, 1, 1), None, dt(2024, 1, 2)),
         ("c", "DAILY", dt(2024, 1, 1), 1, dt(2024, 1, 9))],
        "rule_id string, freq string, dtstart timestamp_ntz, count int, until timestamp_ntz",
    )
    counts = rec.count_occurrences(df, rec.expand(df))
    assert rows(counts) == [("a", 3), ("b", 2), ("c", 1)]


def test_easter_and_weeks_against_the_calendar(spark):
    known = {1961: (4, 2), 1981: (4, 19), 2000: (4, 23), 2024: (3, 31), 2038: (4, 25), 2285: (3, 22)}
    df = spark.createDataFrame([(y,) for y in known], "y int").select("y", rec.easter(F.col("y")).alias("e"))
    assert {r.y: (r.e.month, r.e.day) for r in df.collect()} == known
    days = spark.sql("select explode(sequence(date'1995-01-01', date'2030-12-31', interval 1 day)) as d")
    number, _ = rec.week_number(F.col("d"), F.lit(0))
    assert days.filter(number != F.weekofyear("d")).isEmpty()


def test_before_after(spark):
    occ = spark.createDataFrame(
        [("r", dt(2024, 1, 1, 9)), ("r", dt(2024, 1, 1, 12)), ("r", dt(2024, 1, 5, 9))],
        "rule_id string, occurrence timestamp_ntz",
    )
    times = spark.createDataFrame(
        [("r", dt(2024, 1, 1, 9)), ("r", dt(2024, 1, 1, 10)), ("r", dt(2024, 1, 3)), ("r", dt(2024, 1, 9)), ("q", dt(2024, 1, 1))],
        "rule_id string, at timestamp_ntz",
    )
    got = {(r.rule_id, r.at): (r.before, r.after) for r in rec.before_after(times, occ).collect()}
    assert got == {
        ("r", dt(2024, 1, 1, 9)): (None, dt(2024, 1, 1, 12)),
        ("r", dt(2024, 1, 1, 10)): (dt(2024, 1, 1, 9), dt(2024, 1, 1, 12)),
        ("r", dt(2024, 1, 3)): (dt(2024, 1, 1, 12), dt(2024, 1, 5, 9)),
        ("r", dt(2024, 1, 9)): (dt(2024, 1, 5, 9), None),
        ("q", dt(2024, 1, 1)): (None, None),
    }
    same = rec.before_after(times.filter("at = timestamp_ntz'2024-01-01 09:00:00'"), occ, inclusive=True).first()
    assert same.before == same.after == dt(2024, 1, 1, 9)


def test_rule_set(spark):
    table = lambda *days: spark.createDataFrame(
        [("s", dt(2024, 1, d)) for d in days], "set_id string, occurrence timestamp_ntz"
    )
    got = rec.rule_set([table(1, 2, 3), table(3, 9)], [table(2), table(7)])
    assert [r[1].day for r in rows(got)] == [1, 3, 9]
    span = spark.createDataFrame([("s", dt(2024, 1, 1), dt(2024, 1, 9))], "rule_id string, low timestamp_ntz, high timestamp_ntz")
    occ = got.withColumnRenamed("set_id", "rule_id")
    assert rec.between(occ, span).count() == 1
    assert rec.between(occ, span, inclusive=True).count() == 3


def test_days_are_filtered_as_rows(spark):
    """A period's days are not filtered by a lambda, which runs uncompiled, unless positions are picked."""
    rules = spark.sql("SELECT 1 AS rule_id, 'MONTHLY' AS freq, TIMESTAMP_NTZ'2024-01-30' AS dtstart, TIMESTAMP_NTZ'2024-04-30' AS until, array(-1) AS bymonthday")
    found = rec.expand(rules, ["MONTHLY"])
    assert "filter(sequence" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(str(r.occurrence)[:10] for r in found.collect()) == ["2024-01-31", "2024-02-29", "2024-03-31", "2024-04-30"]


def test_a_short_counted_rule_is_cut_in_its_own_row(spark):
    """No row is shuffled or sorted for it; rules that repeat or are long are brought together by id."""
    fields = dict(until="2024-05-30", count=3, byweekday=[0, 1, 2, 3, 4], bysetpos=[1, -2])
    short = [rule(i, "MONTHLY", f"2024-01-{i + 1:02d}", fields) for i in range(20)]
    plan = rec.expand(spark.createDataFrame(short, SCHEMA).filter("until is not null"), ["MONTHLY"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan.split("Checkpoint")[0] and "Sort" not in plan.split("Checkpoint")[0]
    ends = dict(until="2200-01-01", count=2)
    odd = [rule(50, "DAILY", "2024-01-01", ends), rule(51, "MONTHLY", "2024-01-31 10:00:00", {**ends, "byhour": [10, 8]}), rule(None, "DAILY", "2024-01-01", ends),
           rule(52, "YEARLY", "2024-02-29", {**ends, "count": 0}), rule(53, "HOURLY", "2024-01-01 22:00:00", {**ends, "until": "2024-01-02"}),
           rule(54, "DAILY", "2024-01-05", {**ends, "until": "2024-01-01"}), short[0], short[0]]
    df = spark.createDataFrame([*short, *odd], SCHEMA)
    got = rows(rec.expand(df, ["HOURLY", *rec.DAY_FREQS]), "rule_id", "occurrence")
    want = rows(rec._first(rec._bounded(df.drop("count"), ["HOURLY", *rec.DAY_FREQS]), df.select("rule_id", "count")), "rule_id", "occurrence")
    assert got == want and [r for r in got if r[0] == 51] == [(51, dt(2024, 1, 31, 10)), (51, dt(2024, 3, 31, 8))]
