"""Relative dates, time zones and mixed time formats over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewloom.functions import moments as m
from viewloom.plans import views

ZONES = ["America/New_York", "Europe/Paris", "Australia/Sydney", "Asia/Kolkata", "UTC"]


def date_relative(spark, d):
    """Shifts of the order date by amounts from the order itself."""
    ts = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_custkey") % 24).cast("int"))
    n = (F.col("o_custkey") % 37).cast("int")
    return views.spread(views.table(spark, d, "orders")).withColumn("ts", ts).select(
        "o_orderkey",
        m.shift(F.col("ts"), months=n).alias("plus_months"),
        m.shift(F.col("ts"), years=-1, days=n).alias("year_back"),
        m.shift(F.col("ts"), hours=25, day=1, weekday=(0, 1)).alias("first_monday"),
        m.shift(F.col("ts"), day=31, hour=0, weekday=(4, -1)).alias("last_friday"),
        m.shift(F.col("ts"), month=2, day=30, minutes=n).alias("end_of_february"),
    )


def date_difference(spark, d):
    orders = views.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    lines = views.spread(views.table(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_quantity"))
    shipped = F.col("l_shipdate") + F.make_dt_interval(mins=(F.col("l_quantity") * 7).cast("int"))
    lines = lines.select("l_orderkey", shipped.alias("shipped"))
    gap = m.difference(F.col("shipped"), F.col("o_orderdate"))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_orderkey", "o_orderdate", "shipped", gap.alias("gap"))
        .select("l_orderkey", "o_orderdate", "shipped", "gap.years", "gap.months", "gap.days", "gap.hours", "gap.minutes")
    )


def tz_normalize(spark, d):
    """Shipments as wall times at night, when clocks change, in five zones."""
    wall = F.col("l_shipdate") + F.make_dt_interval(mins=F.lit(150))
    zone = F.element_at(F.array(*[F.lit(z) for z in ZONES]), (F.col("l_suppkey") % 5 + 1).cast("int"))
    df = views.spread(views.table(spark, d, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_partkey", wall.alias("wall"), zone.alias("zone")
    )
    at, z = F.col("wall"), F.col("zone")
    return df.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "zone",
        "wall",
        m.wall_to_utc(at, z).alias("utc"),
        m.wall_exists(at, z).alias("exists_"),
        m.wall_is_ambiguous(at, z).alias("ambiguous"),
    )


def _raw_times(spark, d):
    """The event time as text, in a format chosen by the event type and value."""
    ts, kind = F.col("ts"), F.col("event_type")
    second = F.col("ts").cast("string").substr(1, 19)
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    monday = F.date_sub(F.to_date("ts"), F.weekday("ts"))
    week_year = F.year(F.date_add(monday, 3))
    raw = (
        F.when((kind == "view") & (F.col("value") < 10), F.concat(iso, F.lit("Z")))
        .when(kind == "view", F.concat(F.date_format(ts + F.expr("interval 330 minutes"), "yyyyMMdd'T'HHmmss"), F.lit("+0530")))
        .when(kind == "click", (F.unix_date(F.to_date(ts)) * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("string"))
        .when((kind == "error") & (F.col("value") < 10), F.concat(week_year.cast("string"), F.lit("-W"), F.lpad(F.weekofyear("ts").cast("string"), 2, "0"), F.lit("-"), (F.weekday("ts") + 1).cast("string"), F.lit("T"), F.date_format("ts", "HH:mm:ss")))
        .when(kind == "error", F.concat(F.date_format("ts", "yyyy-"), F.lpad(F.dayofyear("ts").cast("string"), 3, "0"), F.date_format("ts", "'T'HH:mm:ss")))
        .when((kind == "signup") & (F.col("value") < 10), F.concat(F.lit("Tue, "), F.date_format(ts - F.expr("interval 5 hours"), "d MMM yyyy HH:mm:ss"), F.lit(" -0500")))
        .when(kind == "signup", F.concat(F.date_format("ts", "dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .when(F.col("value") < 10, F.lit("2024-02-30T00:00:00Z"))
        .otherwise(F.concat(F.lit("at "), second))
    )
    return views.spread(views.table(spark, d, "events")).select("event_id", raw.alias("raw"))


def ts_mixed_parse(spark, d):
    return _raw_times(spark, d).select("event_id", m.read_time(F.col("raw")).alias("t")).select(
        "event_id", "t.format", "t.parsed"
    )


def ts_parse_quality(spark, d):
    """Readable and unreadable texts per format."""
    parsed = _raw_times(spark, d).select(m.read_time(F.col("raw")).alias("t")).select("t.*")
    return parsed.groupBy(F.coalesce("format", F.lit("unknown")).alias("format")).agg(
        F.count(F.lit(1)).alias("texts"), F.count("parsed").alias("readable")
    )


QUERIES = {
    "date_relative": date_relative,
    "date_difference": date_difference,
    "tz_normalize": tz_normalize,
    "ts_mixed_parse": ts_mixed_parse,
    "ts_parse_quality": ts_parse_quality,
}

_FORMATS = """f AS (
  SELECT event_id, date_trunc('second', ts) AS t,
    CASE WHEN event_type = 'view' AND value < 10 THEN 'iso' WHEN event_type = 'view' THEN 'iso_basic'
         WHEN event_type = 'click' THEN 'epoch' WHEN event_type = 'error' AND value < 10 THEN 'iso_week'
         WHEN event_type = 'error' THEN 'iso_ordinal' WHEN event_type = 'signup' THEN 'mail'
         WHEN value < 10 THEN 'iso' END AS format,
    event_type = 'purchase' AND value < 10 AS broken FROM events)"""

SQL = {
    "date_relative": """WITH o AS (
  SELECT o_orderkey, o_orderdate + to_hours(o_custkey % 24) AS ts, CAST(o_custkey % 37 AS INTEGER) AS n FROM orders),
x AS (
  SELECT *, date_trunc('month', ts) + (ts - date_trunc('day', ts)) + to_hours(25) AS m1,
         CAST(last_day(ts) AS TIMESTAMP) + (ts - date_trunc('hour', ts)) AS ml,
         make_date(year(ts), 2, 1) AS feb FROM o)
SELECT o_orderkey, ts + to_months(n) AS plus_months, (ts - to_months(12)) + to_days(n) AS year_back,
       m1 + to_days(CAST((8 - isodow(m1)) % 7 AS INTEGER)) AS first_monday,
       ml - to_days(CAST((isodow(ml) + 2) % 7 AS INTEGER)) AS last_friday,
       CAST(last_day(feb) AS TIMESTAMP) + (ts - date_trunc('day', ts)) + to_minutes(n) AS end_of_february
FROM x""",
    "date_difference": """WITH x AS (
  SELECT l_orderkey, o_orderdate, l_shipdate + to_minutes(CAST(l_quantity * 7 AS INTEGER)) AS shipped
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
c AS (
  SELECT *, (year(shipped) - year(o_orderdate)) * 12 + month(shipped) - month(o_orderdate) AS k FROM x),
t AS (
  SELECT *, CASE WHEN shipped >= o_orderdate AND shipped < o_orderdate + to_months(CAST(k AS INTEGER)) THEN k - 1
                 WHEN shipped < o_orderdate AND shipped > o_orderdate + to_months(CAST(k AS INTEGER)) THEN k + 1
                 ELSE k END AS n FROM c),
r AS (
  SELECT *, epoch_us(shipped) - epoch_us(o_orderdate + to_months(CAST(n AS INTEGER))) AS us FROM t)
SELECT l_orderkey, o_orderdate, shipped, CAST(trunc(n / 12) AS BIGINT) AS years,
       CAST(n - trunc(n / 12) * 12 AS BIGINT) AS months,
       CAST(trunc(us / 86400000000) AS BIGINT) AS days,
       CAST(trunc((us - trunc(us / 86400000000) * 86400000000) / 3600000000) AS BIGINT) AS hours,
       CAST(trunc((us - trunc(us / 3600000000) * 3600000000) / 60000000) AS BIGINT) AS minutes FROM r""",
    "ts_mixed_parse": f"""WITH {_FORMATS}
SELECT event_id, format, CASE WHEN format IS NOT NULL AND NOT broken THEN t END AS parsed FROM f""",
    "ts_parse_quality": f"""WITH {_FORMATS}
SELECT coalesce(format, 'unknown') AS format, count(*) AS texts,
       count(*) FILTER (WHERE format IS NOT NULL AND NOT broken) AS readable FROM f GROUP BY 1""",
    # DuckDB takes the later of two candidate instants, this package the earlier one.
    "tz_normalize": f"""WITH x AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate + to_minutes(150) AS wall,
         list_extract({ZONES!r}, l_suppkey % 5 + 1) AS zone FROM lineitem),
u AS (
  SELECT *, timezone('UTC', timezone(zone, wall)) AS late,
         timezone('UTC', timezone(zone, wall)) - to_hours(1) AS early FROM x),
r AS (
  SELECT *, timezone(zone, timezone('UTC', late)) AS back, timezone(zone, timezone('UTC', early)) AS early_back FROM u)
SELECT l_orderkey, l_linenumber, l_partkey, zone, wall, CASE WHEN early_back = wall THEN early ELSE late END AS utc,
       back = wall AS exists_, early_back = wall AS ambiguous FROM r""",
}
