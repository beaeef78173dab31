"""Validation by a table of rules, over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewloom.operators import quality, rules
from viewloom.plans import views
from viewloom.plans.quality_queries import _VIOLATIONS, ORDER_SHAPE, _order_records
from viewloom.session import scratch_path


def _written(df, name):
    """The rules as the table they would be kept in."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _cents(column):
    return (F.col(column).cast("decimal(18,2)") * 100).cast("bigint")


def _order_rules(spark, d):
    """The rules of orders for each priority, whose least price is the mean of the priority's orders."""
    kinds = spark.createDataFrame([r[1:] for r in rules.rules_of(ORDER_SHAPE)], "path string, type string, required boolean, least double")
    mean = F.expr("sum(cents) div count(1)") / 100
    feeds = views.table(spark, d, "orders").select(F.col("o_orderpriority").alias("feed"), _cents("o_totalprice").alias("cents"))
    feeds = feeds.groupBy("feed").agg(mean.alias("mean"))
    each = feeds.join(F.broadcast(kinds), F.lit(True))  # five feeds, a dozen kinds
    least = F.when(F.col("path") == ".price", F.col("mean")).otherwise(F.col("least"))
    return _written(each.select("feed", "path", "type", "required", least.alias("min")), "rules")


def dq_rules(spark, d):
    return rules.violation_rows(_order_records(spark, d), "record", _order_rules(spark, d), ["o_orderkey"], "feed")


def dq_rules_report(spark, d):
    return quality.violation_report(dq_rules(spark, d))


def _line_records(spark, d):
    """Orders with the list of their lines, some without a flag, quantity as text or a further member."""
    no = F.col("l_linenumber").cast("int")
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    ship = F.when(no % 3 == 0, F.struct(F.col("l_linestatus").alias("status"), F.lit(True).alias("odd"))).otherwise(
        F.struct(F.col("l_linestatus").alias("status"), F.lit(None).cast("boolean").alias("odd"))
    )
    quantity = F.when(no == 2, F.concat(F.lit('"'), F.col("l_quantity").cast("int"), F.lit('"'))).otherwise(F.col("l_quantity").cast("int").cast("string"))
    rest = F.to_json(F.struct(flag.alias("flag"), ship.alias("ship")))
    line = F.concat(F.lit('{"qty":'), quantity, F.lit(',"m":{"x":1},'), F.substring(rest, F.lit(2), F.length(rest)))
    order = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", line.alias("line"))))
    lines = views.table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(order, lambda r: r["line"]), ",").alias("lines"))
    return lines.select("l_orderkey", F.parse_json(F.concat(F.lit('{"lines":['), "lines", F.lit("]}"))).alias("record"))


def _line_rules(spark, d):
    """Rules of nested lists; the least quantity is that of the lines flagged R, one more."""
    least = views.table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R").agg((F.min("l_quantity") + 1).alias("least"))
    row = lambda path, kind, required=False, least=None: F.struct(
        F.lit(path).alias("path"), F.lit(kind).alias("type"), F.lit(required).alias("required"), (F.lit(None).cast("double") if least is None else least).alias("min")
    )
    each = F.inline(
        F.array(
            row("lines", "list", True, F.lit(2.0)),
            row("lines[].qty", "integer", True, F.col("least")),
            row("lines[].flag", "string", True),
            row("lines[].m{}", "integer"),
            row("lines[].m{key}", "string", False, F.lit(2.0)),
            row("lines[].ship.status", "string"),
        )
    )
    return _written(least.select(each), "rules")


def dq_rules_nested(spark, d):
    return rules.violation_rows(_line_records(spark, d), "record", _line_rules(spark, d), ["l_orderkey"])


QUERIES = {"dq_rules": dq_rules, "dq_rules_report": dq_rules_report, "dq_rules_nested": dq_rules_nested}

# The least price is that of the order's priority.
_BY_FEED = _VIOLATIONS.replace("o AS (", "means AS (SELECT o_orderpriority AS p, sum(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)) // count(*) AS mean FROM orders GROUP BY 1),\no AS (").replace(
    "FROM o WHERE price < 50000", "FROM o JOIN means USING (p) WHERE CAST(price AS DOUBLE) < mean / 100.0"
)

SQL = {
    "dq_rules": f"WITH {_BY_FEED} SELECT * FROM v",
    "dq_rules_report": f"""WITH {_BY_FEED}
SELECT regexp_replace(path, '[[][0-9]+[]]', '[]') AS path, reason, count(*) AS violations FROM v GROUP BY 1, 2""",
    "dq_rules_nested": """WITH l AS (
  SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS n, l_quantity AS q, l_returnflag AS f,
         '.lines[' || (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                       l_quantity, l_returnflag, l_linestatus) - 1) || ']' AS place FROM lineitem),
least AS (SELECT min(l_quantity) + 1 AS least FROM lineitem WHERE l_returnflag = 'R')
SELECT l_orderkey, '.lines' AS path, 'invalid length' AS reason, '1' AS detail FROM l GROUP BY l_orderkey HAVING count(*) = 1
UNION ALL SELECT l_orderkey, place || '.qty', 'invalid type', 'string' FROM l WHERE n = 2
UNION ALL SELECT l_orderkey, place || '.qty', 'invalid range', CAST(CAST(q AS INTEGER) AS VARCHAR) FROM l, least WHERE n <> 2 AND q < least
UNION ALL SELECT l_orderkey, place, 'missing required field', 'flag' FROM l WHERE f = 'N'
UNION ALL SELECT l_orderkey, place || '.m (key: x)', 'invalid length', '"x"' FROM l
UNION ALL SELECT l_orderkey, place || '.ship', 'unknown field', 'odd' FROM l WHERE n % 3 = 0""",
}
