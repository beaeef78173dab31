from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from viewloom.functions import moments as m


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def one(spark, column):
    return spark.range(1).select(column).first()[0]


SHIFTS = [
    ("2018-04-09 13:37:00", dict(hours=25, day=1, weekday=(0, 1)), "2018-04-02 14:37:00"),
    ("2003-01-31 00:00:00", dict(months=1), "2003-02-28 00:00:00"),
    ("2004-02-29 10:00:00", dict(years=1), "2005-02-28 10:00:00"),
    ("2003-09-17 20:54:47.282310", dict(months=-14, weeks=1), "2002-07-24 20:54:47.282310"),
    ("2003-09-17 20:54:47", dict(hour=10, minute=0, second=5, microsecond=9), "2003-09-17 10:00:05.000009"),
    ("2003-09-17 20:54:47.5", dict(second=1), "2003-09-17 20:54:01.5"),
    ("2003-09-17 00:00:00", dict(weekday=(4, -1)), "2003-09-12 00:00:00"),
    ("2003-09-17 00:00:00", dict(weekday=2), "2003-09-17 00:00:00"),
    ("2003-09-17 00:00:00", dict(day=31, weekday=(4, -1)), "2003-09-26 00:00:00"),
    ("2003-01-01 00:00:00", dict(yearday=260), "2003-09-17 00:00:00"),
    ("2000-01-01 00:00:00", dict(yearday=260), "2000-09-16 00:00:00"),
    ("2000-01-01 00:00:00", dict(nlyearday=260), "2000-09-17 00:00:00"),
    ("2024-01-31 23:59:59", dict(year=2023, month=2, microseconds=1_500_000), "2023-03-01 00:00:00.5"),
]


@pytest.mark.parametrize("start,amount,expected", SHIFTS, ids=str)
def test_shift(spark, start, amount, expected):
    assert one(spark, m.shift(ts(start), **amount)) == dt.fromisoformat(expected)


DIFFERENCES = [
    ("2003-10-24 00:00:00", "2003-09-17 20:54:47.282310", (0, 1, 6, 3, 5, 12, 717690)),
    ("2003-09-17 20:54:47.282310", "2003-10-24 00:00:00", (0, -1, -6, -3, -5, -12, -717690)),
    ("2024-03-31 00:00:00", "2024-02-29 12:00:00", (0, 1, 1, 12, 0, 0, 0)),
    ("2024-02-29 00:00:00", "2023-02-28 00:00:00", (1, 0, 1, 0, 0, 0, 0)),
    ("2020-02-29 00:00:00", "2024-03-31 00:00:00", (-4, -1, 0, 0, 0, 0, 0)),
]


@pytest.mark.parametrize("later,earlier,expected", DIFFERENCES, ids=str)
def test_difference(spark, later, earlier, expected):
    assert tuple(one(spark, m.difference(ts(later), ts(earlier)))) == expected


def test_gap_moves_forward(spark):
    assert one(spark, m.resolve_gap(ts("2017-03-12 02:30:00"), "America/New_York")) == dt(2017, 3, 12, 3, 30)
    assert one(spark, m.resolve_gap(ts("2017-03-12 04:30:00"), "America/New_York")) == dt(2017, 3, 12, 4, 30)
    assert one(spark, m.wall_exists(ts("2017-03-12 02:30:00"), "America/New_York")) is False
    # a whole day was skipped here
    assert one(spark, m.wall_exists(ts("2011-12-30 12:00:00"), "Pacific/Apia")) is False


@pytest.mark.parametrize(
    "wall,zone,expected",
    [("2017-11-05 01:30:00", "America/New_York", True), ("2017-11-05 02:30:00", "America/New_York", False),
     ("2017-11-05 00:59:59", "America/New_York", False), ("2019-04-07 01:45:00", "Australia/Lord_Howe", True),
     ("2019-04-07 01:15:00", "Australia/Lord_Howe", False), ("2019-06-01 01:00:00", "UTC", False)],
)
def test_ambiguous(spark, wall, zone, expected):
    assert one(spark, m.wall_is_ambiguous(ts(wall), zone)) is expected


def test_within(spark):
    assert one(spark, m.within(ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:01.5"), 1.5)) is True
    assert one(spark, m.within(ts("2024-01-01 00:00:02"), ts("2024-01-01 00:00:00"), -1)) is False


TEXTS = [
    ("0", "epoch", "1970-01-01 00:00:00"),
    ("-1.5", "epoch", "1969-12-31 23:59:58.5"),
    ("1700000000.25", "epoch", "2023-11-14 22:13:20.25"),
    ("2024-01-02", "iso", "2024-01-02 00:00:00"),
    ("2024-01-02T03:04", "iso", "2024-01-02 03:04:00"),
    ("2024-01-02T03:04:05.123456789Z", "iso", "2024-01-02 03:04:05.123456"),
    ("2024-01-02T03:04:05,5-05:30", "iso", "2024-01-02 08:34:05.5"),
    ("2024-01-02 03+02", "iso", "2024-01-02 01:00:00"),
    ("20240102T030405Z", "iso_basic", "2024-01-02 03:04:05"),
    ("2024-01-02T24:00", "iso", "2024-01-03 00:00:00"),
    ("2024-01-02T24:01", "iso", None),
    ("2024-13-02", "iso", None),
    ("2023-02-29", "iso", None),
    ("2024-01", "iso_month", "2024-01-01 00:00:00"),
    ("2009-W01-1", "iso_week", "2008-12-29 00:00:00"),
    ("2009W537T10", "iso_week", "2010-01-03 10:00:00"),
    ("2004-W17", "iso_week", "2004-04-19 00:00:00"),
    ("2024-W54-1", "iso_week", None),
    ("2024-366", "iso_ordinal", "2024-12-31 00:00:00"),
    ("2023-366", "iso_ordinal", None),
    ("2024032T0102", "iso_ordinal", "2024-02-01 01:02:00"),
    ("Wed, 02 Oct 2002 13:00:00 GMT", "mail", "2002-10-02 13:00:00"),
    ("2 oct 2002 13:00 +0200", "mail", "2002-10-02 11:00:00"),
    ("31 Feb 2002 13:00:00 GMT", "mail", None),
    ("yesterday", None, None),
    ("", None, None),
]


def test_mixed_texts(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(TEXTS)], "i int, raw string")
    for zone in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = {r.i: (r.format, r.parsed) for r in df.select("i", m.read_time(F.col("raw")).alias("t")).select("i", "t.*").collect()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        for i, (text, label, expected) in enumerate(TEXTS):
            assert got[i] == (label, dt.fromisoformat(expected) if expected else None), text
