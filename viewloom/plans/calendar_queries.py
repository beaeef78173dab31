"""Recurrence queries over rules made from the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewloom.operators import calendar_bits
from viewloom.operators import recurrence as rec
from viewloom.plans import views

FREQ_OF_PRIORITY = {
    "1-URGENT": ("DAILY", 60),
    "2-HIGH": ("WEEKLY", 200),
    "3-MEDIUM": ("MONTHLY", 400),
    "4-NOT SPECIFIED": ("YEARLY", 2000),
    "5-LOW": ("DAILY", 30),
}
DAY_FREQS = ["DAILY", "WEEKLY", "MONTHLY", "YEARLY"]


def _pick(column, values):
    """A CASE over a column's values."""
    picked = None
    for value, result in values.items():
        hit = F.col(column) == value
        picked = F.when(hit, result) if picked is None else picked.when(hit, result)
    return picked


def _days_after(ts, days):
    return ts + F.make_dt_interval(days=days)


def _order_rules(spark, d, with_hours=True):
    """One rule per order: it starts on the order date, its frequency and length
    follow the priority, its interval and hour the customer."""
    hours = F.make_dt_interval(hours=(F.col("o_custkey") % 24).cast("int")) if with_hours else F.make_dt_interval()
    start = F.col("o_orderdate") + hours
    span = _pick("o_orderpriority", {k: F.lit(v[1]) for k, v in FREQ_OF_PRIORITY.items()})
    return views.spread(views.table(spark, d, "orders")).select(
        F.col("o_orderkey").alias("rule_id"),
        _pick("o_orderpriority", {k: F.lit(v[0]) for k, v in FREQ_OF_PRIORITY.items()}).alias("freq"),
        start.alias("dtstart"),
        (F.col("o_custkey") % 3 + 1).cast("int").alias("interval"),
        _days_after(start, span).alias("until"),
    )


def recur_expand(spark, d):
    return rec.expand(_order_rules(spark, d), DAY_FREQS)


def recur_count(spark, d):
    return calendar_bits.count_by_bits(_order_rules(spark, d))


def recur_nth(spark, d):
    """The fifth occurrence of each order's rule."""
    return calendar_bits.nth_by_bits(_order_rules(spark, d), F.lit(5))


def recur_hourly(spark, d):
    """Sub-daily rules, one per customer; machinery fires twice an hour, by day only."""
    start = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        mins=(F.col("c_custkey") % 1440).cast("int")
    )
    segment = "c_mktsegment"
    machinery = F.col(segment) == "MACHINERY"
    rules = views.spread(views.table(spark, d, "customer")).select(
        F.col("c_custkey").alias("rule_id"),
        _pick(segment, {
            "BUILDING": F.lit("HOURLY"), "AUTOMOBILE": F.lit("MINUTELY"), "MACHINERY": F.lit("HOURLY"),
            "HOUSEHOLD": F.lit("SECONDLY"), "FURNITURE": F.lit("HOURLY"),
        }).alias("freq"),
        start.alias("dtstart"),
        _pick(segment, {
            "BUILDING": F.lit(5), "AUTOMOBILE": F.lit(45), "MACHINERY": F.lit(1),
            "HOUSEHOLD": F.lit(1801), "FURNITURE": F.lit(25),
        }).alias("interval"),
        _days_after(start, F.lit(2)).alias("until"),
        F.when(machinery, F.array(F.lit(8), F.lit(12), F.lit(16))).alias("byhour"),
        F.when(machinery, F.array(F.lit(15), F.lit(45))).alias("byminute"),
    )
    return rec.expand(rules, ["HOURLY", "MINUTELY", "SECONDLY"])


def recur_filters(spark, d):
    """Each market segment uses another family of day filters."""
    start = _days_after(F.lit("2020-01-01").cast("timestamp_ntz"), (F.col("c_custkey") % 365).cast("int"))
    segment = F.col("c_mktsegment")
    ints = lambda *values: F.array(*[F.lit(v) for v in values])
    rules = views.spread(views.table(spark, d, "customer")).select(
        F.col("c_custkey").alias("rule_id"),
        F.when(segment.isin("BUILDING", "AUTOMOBILE"), "MONTHLY").otherwise("YEARLY").alias("freq"),
        start.alias("dtstart"),
        _days_after(start, F.lit(1000)).alias("until"),
        F.when(segment == "BUILDING", rec.weekday_set((1, 2), (4, -1)))
        .when(segment == "MACHINERY", rec.weekday_set(0))
        .alias("byweekday"),
        F.when(segment == "AUTOMOBILE", ints(15, -1)).alias("bymonthday"),
        F.when(segment == "MACHINERY", ints(1, 20, -1)).alias("byweekno"),
        F.when(segment == "HOUSEHOLD", ints(1, 100, -1)).alias("byyearday"),
        F.when(segment == "FURNITURE", ints(0, 50)).alias("byeaster"),
        F.when(segment == "AUTOMOBILE", ints(2, 3, 12)).alias("bymonth"),
    )
    return rec.expand(rules, ["MONTHLY", "YEARLY"])


def recur_setpos(spark, d):
    """First and last-but-one working day of the month, three times at most."""
    rules = views.spread(views.table(spark, d, "orders")).select(
        F.col("o_orderkey").alias("rule_id"),
        F.lit("MONTHLY").alias("freq"),
        F.col("o_orderdate").alias("dtstart"),
        _days_after(F.col("o_orderdate"), F.lit(120)).alias("until"),
        F.lit(3).alias("count"),
        rec.weekday_set(0, 1, 2, 3, 4).alias("byweekday"),
        F.array(F.lit(1), F.lit(-2)).alias("bysetpos"),
    )
    return rec.expand(rules, ["MONTHLY"])


def recur_open_count(spark, d):
    """Five occurrences of a monthly rule on the 29th to 31st; no end is given."""
    start = _days_after(F.lit("2023-01-29").cast("timestamp_ntz"), (F.col("s_suppkey") % 3).cast("int"))
    rules = views.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("rule_id"),
        F.lit("MONTHLY").alias("freq"),
        start.alias("dtstart"),
        (F.col("s_nationkey") % 4 + 1).cast("int").alias("interval"),
        F.lit(5).alias("count"),
    )
    return rec.expand(rules, ["MONTHLY"])


def recur_lookup(spark, d):
    """Scheduled occurrences around each shipment of the order."""
    shipped = F.col("l_shipdate") + F.make_dt_interval(hours=(F.col("l_quantity") % 24).cast("int"))
    times = views.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("rule_id"), shipped.alias("at"))
    return rec.before_after(times, rec.expand(_order_rules(spark, d), DAY_FREQS))


def recur_between(spark, d):
    spans = views.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("rule_id"),
        _days_after(F.col("o_orderdate"), F.lit(14)).alias("low"),
        _days_after(F.col("o_orderdate"), F.lit(49)).alias("high"),
    )
    found = rec.between(rec.expand(_order_rules(spark, d, False), DAY_FREQS), spans, inclusive=True)
    return found.select("rule_id", "occurrence")


def recur_set(spark, d):
    """Per customer: all order rules plus one extra date per order, without a
    monthly exclusion rule and an excluded date per order."""
    orders = views.table(spark, d, "orders")
    owner = orders.select(F.col("o_orderkey").alias("rule_id"), F.col("o_custkey").alias("set_id"))
    rules = _order_rules(spark, d, False)
    monthly = orders.select(
        F.col("o_orderkey").alias("rule_id"),
        F.lit("MONTHLY").alias("freq"),
        F.col("o_orderdate").alias("dtstart"),
        _days_after(F.col("o_orderdate"), F.lit(100)).alias("until"),
    )
    single = lambda days: orders.select(
        F.col("o_custkey").alias("set_id"), _days_after(F.col("o_orderdate"), F.lit(days)).alias("occurrence")
    )
    return rec.rule_set(
        [rec.expand(rules, DAY_FREQS).join(owner, "rule_id"), single(45)],
        [rec.expand(monthly, ["MONTHLY"]).join(owner, "rule_id"), single(2)],
    )


QUERIES = {
    "recur_expand": recur_expand,
    "recur_count": recur_count,
    "recur_nth": recur_nth,
    "recur_hourly": recur_hourly,
    "recur_filters": recur_filters,
    "recur_setpos": recur_setpos,
    "recur_open_count": recur_open_count,
    "recur_lookup": recur_lookup,
    "recur_between": recur_between,
    "recur_set": recur_set,
}


def _rules_sql(with_hours: bool) -> str:
    start = "o_orderdate + to_hours(o_custkey % 24)" if with_hours else "o_orderdate"
    span = " ".join(f"WHEN '{k}' THEN {v[1]}" for k, v in FREQ_OF_PRIORITY.items())
    freq = " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in FREQ_OF_PRIORITY.items())
    return f"""rules AS (
  SELECT o_orderkey AS rule_id, o_custkey AS set_id, CASE o_orderpriority {freq} END AS freq, {start} AS dtstart,
         o_custkey % 3 + 1 AS step, {start} + to_days(CASE o_orderpriority {span} END) AS until FROM orders),
slots AS (
  SELECT rule_id, set_id, freq, dtstart, until, step, unnest(range(70)) AS i FROM rules),
dates AS (
  SELECT rule_id, set_id, until, dtstart + to_days(CAST(i * step * CASE freq WHEN 'WEEKLY' THEN 7 ELSE 1 END AS INTEGER)) AS occurrence
  FROM slots WHERE freq IN ('DAILY', 'WEEKLY')
  UNION ALL
  SELECT rule_id, set_id, until, date_trunc('month', dtstart) + to_months(CAST(i * step * CASE freq WHEN 'YEARLY' THEN 12 ELSE 1 END AS INTEGER))
         + (dtstart - date_trunc('month', dtstart)) AS occurrence
  FROM slots WHERE freq IN ('MONTHLY', 'YEARLY')
    AND day(last_day(date_trunc('month', dtstart) + to_months(CAST(i * step * CASE freq WHEN 'YEARLY' THEN 12 ELSE 1 END AS INTEGER)))) >= day(dtstart)),
occ AS (SELECT rule_id, set_id, occurrence FROM dates WHERE occurrence <= until)"""


SQL = {
    "recur_expand": f"WITH {_rules_sql(True)} SELECT rule_id, occurrence FROM occ",
    "recur_count": f"WITH {_rules_sql(True)} SELECT rule_id, count(*) AS occurrences FROM occ GROUP BY rule_id",
    "recur_nth": f"""WITH {_rules_sql(True)}
SELECT rule_id, occurrence FROM occ QUALIFY row_number() OVER (PARTITION BY rule_id ORDER BY occurrence) = 5""",
    "recur_hourly": """WITH r AS (
  SELECT c_custkey AS rule_id, c_mktsegment AS seg,
         TIMESTAMP '2024-01-01' + to_minutes(c_custkey % 1440) AS dtstart FROM customer),
s AS (
  SELECT rule_id, dtstart, unnest(range(200)) AS i,
         CASE seg WHEN 'BUILDING' THEN 18000 WHEN 'AUTOMOBILE' THEN 2700 WHEN 'HOUSEHOLD' THEN 1801
                  WHEN 'FURNITURE' THEN 90000 END AS step
  FROM r WHERE seg <> 'MACHINERY'),
m AS (
  SELECT rule_id, dtstart, TIMESTAMP '2024-01-01' + to_days(CAST(a AS INTEGER)) + to_hours(h) + to_minutes(q) AS occurrence
  FROM r, range(4) d(a), (VALUES (8), (12), (16)) hs(h), (VALUES (15), (45)) ms(q) WHERE seg = 'MACHINERY')
SELECT rule_id, dtstart + to_seconds(i * step) AS occurrence FROM s WHERE i * step <= 172800
UNION ALL
SELECT rule_id, occurrence FROM m WHERE occurrence BETWEEN dtstart AND dtstart + to_days(2)""",
    "recur_filters": """WITH r AS (
  SELECT c_custkey AS rule_id, c_mktsegment AS seg,
         TIMESTAMP '2020-01-01' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS dtstart FROM customer),
d AS (SELECT rule_id, seg, dtstart + to_days(CAST(i AS INTEGER)) AS t FROM r, range(1001) x(i)),
c AS (
  SELECT *, isodow(t) AS w, day(t) AS dom, day(last_day(t)) AS dim, dayofyear(t) AS doy,
         dayofyear(make_date(year(t), 12, 31)) AS diy, weekofyear(t) AS wk,
         weekofyear(make_date(isoyear(t), 12, 28)) AS wks FROM d)
SELECT rule_id, t AS occurrence FROM c WHERE CASE seg
  WHEN 'BUILDING' THEN (w = 2 AND dom BETWEEN 8 AND 14) OR (w = 5 AND dom > dim - 7)
  WHEN 'AUTOMOBILE' THEN month(t) IN (2, 3, 12) AND (dom = 15 OR dom = dim)
  WHEN 'MACHINERY' THEN w = 1 AND (wk IN (1, 20) OR wk = wks)
  WHEN 'HOUSEHOLD' THEN doy IN (1, 100) OR doy = diy
  ELSE CAST(t AS DATE) IN (DATE '2020-04-12', DATE '2021-04-04', DATE '2022-04-17', DATE '2023-04-09',
       DATE '2020-06-01', DATE '2021-05-24', DATE '2022-06-06', DATE '2023-05-29') END""",
    "recur_setpos": """WITH m AS (
  SELECT DISTINCT date_trunc('month', o_orderdate) + to_months(CAST(i AS INTEGER)) AS month FROM orders, range(6) x(i)),
d AS (
  SELECT month, month + to_days(CAST(i AS INTEGER)) AS t FROM m, range(31) x(i)
  WHERE month(month + to_days(CAST(i AS INTEGER))) = month(month) AND isodow(month + to_days(CAST(i AS INTEGER))) <= 5),
p AS (
  SELECT month, t FROM d QUALIFY row_number() OVER (PARTITION BY month ORDER BY t) = 1
                              OR row_number() OVER (PARTITION BY month ORDER BY t DESC) = 2),
j AS (
  SELECT o_orderkey AS rule_id, t AS occurrence FROM orders JOIN p
    ON t BETWEEN o_orderdate AND o_orderdate + to_days(120))
SELECT rule_id, occurrence FROM j
QUALIFY row_number() OVER (PARTITION BY rule_id ORDER BY occurrence) <= 3""",
    "recur_open_count": """WITH r AS (
  SELECT s_suppkey AS rule_id, 29 + s_suppkey % 3 AS dom, s_nationkey % 4 + 1 AS step FROM supplier),
c AS (
  SELECT rule_id, dom, DATE '2023-01-01' + to_months(CAST(i * step AS INTEGER)) AS m FROM r, range(60) x(i))
SELECT rule_id, m + to_days(CAST(dom - 1 AS INTEGER)) AS occurrence FROM c WHERE day(last_day(m)) >= dom
QUALIFY row_number() OVER (PARTITION BY rule_id ORDER BY m) <= 5""",
    "recur_lookup": f"""WITH {_rules_sql(True)},
t AS (SELECT l_orderkey AS rule_id, l_shipdate + to_hours(CAST(l_quantity % 24 AS INTEGER)) AS at, row_number() OVER () AS rid FROM lineitem)
SELECT t.rule_id, t.at, max(o.occurrence) FILTER (WHERE o.occurrence < t.at) AS before,
       min(o.occurrence) FILTER (WHERE o.occurrence > t.at) AS after
FROM t LEFT JOIN occ o ON o.rule_id = t.rule_id GROUP BY t.rid, t.rule_id, t.at""",
    "recur_between": f"""WITH {_rules_sql(False)}
SELECT occ.rule_id, occurrence FROM occ JOIN orders ON o_orderkey = rule_id
WHERE occurrence BETWEEN o_orderdate + to_days(14) AND o_orderdate + to_days(49)""",
    "recur_set": f"""WITH {_rules_sql(False)},
ex AS (
  SELECT o_custkey AS set_id, date_trunc('month', o_orderdate) + to_months(CAST(i AS INTEGER)) + to_days(CAST(day(o_orderdate) - 1 AS INTEGER)) AS occurrence
  FROM orders, range(5) x(i)
  WHERE day(last_day(date_trunc('month', o_orderdate) + to_months(CAST(i AS INTEGER)))) >= day(o_orderdate)
    AND date_trunc('month', o_orderdate) + to_months(CAST(i AS INTEGER)) + to_days(CAST(day(o_orderdate) - 1 AS INTEGER)) <= o_orderdate + to_days(100)
  UNION ALL SELECT o_custkey, o_orderdate + to_days(2) FROM orders)
SELECT set_id, occurrence FROM occ UNION SELECT o_custkey, o_orderdate + to_days(45) FROM orders
EXCEPT SELECT set_id, occurrence FROM ex""",
}
