"""Network, URL, data-quality and tagged-value queries over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewloom.functions import tagged, urls
from viewloom.operators import network, quality
from viewloom.operators.quality import ListOf, MapOf, Scalar, Structure
from viewloom.plans import views
from viewloom.plans.views import EVENT_STATS


def _blocks(spark, d):
    """Blocks of several lengths, labelled by nation."""
    n = F.col("n_nationkey")
    text = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    block = F.explode(
        F.array(
            text("10.", (n % 3).cast("string"), ".0.0/16"),
            text("10.", (n % 4).cast("string"), ".", (n % 7).cast("string"), ".9/24"),
            text("10.", (n % 4).cast("string"), ".", (n % 7).cast("string"), ".", (n * 10).cast("string"), "/29"),
            text("10.", n.cast("string"), ".0.0/33"),
        )
    )
    return views.table(spark, d, "nation").select(F.col("n_name").alias("label"), block.alias("block"))


def ip_cidr_join(spark, d):
    events = views.event_stats(spark, d).select("media_id", "visitor_key", "ip")
    return network.match_blocks(events, "ip", _blocks(spark, d)).select("media_id", "visitor_key", "ip", "label")


def _messy_urls(spark, d):
    """The page URLs, spoiled in ways the canonical form must undo."""
    at = lambda n: F.regexp_extract("url", r"^([a-z]+)://([^/]+)([^?#]*)(.*)$", n)
    kind = F.length("html") % 4
    spoiled = (
        F.when(kind == 0, F.concat(F.upper(at(1)), F.lit("://"), F.upper(at(2)), F.lit(":"), at(3), at(4)))
        .when(kind == 1, F.concat(at(1), F.lit("://"), F.initcap(at(2)), F.lit("/x/.././."), at(3), at(4)))
        .when(kind == 2, F.concat(at(1), F.lit("://User%3a@"), at(2), F.lit(":0080"), at(3), F.lit("/a b%7e"), at(4)))
        .otherwise(F.concat(at(1), F.lit("://"), at(2), F.lit(":70000"), at(3)))
    )
    return views.spread(views.table(spark, d, "pages")).select("page_id", "url", spoiled.alias("messy"))


def url_canonical(spark, d):
    return _messy_urls(spark, d).select("page_id", urls.canonical_url(F.col("messy")).alias("canonical"))


def url_parts(spark, d):
    parsed = views.spread(views.table(spark, d, "pages")).select("page_id", urls.parse_url(F.col("url")).alias("u"))
    return parsed.select("page_id", "u.scheme", "u.auth", "u.host", "u.port", "u.path", "u.query", "u.fragment")


def url_host_rollup(spark, d):
    return urls.host_rollup(views.spread(views.table(spark, d, "pages")).select("url"), "url")


ORDER_SHAPE = Structure(
    members={
        "key": Scalar("integer", min=10),
        "status": Scalar("string", min=1),
        "price": Scalar("double", min=50000),
        "urgent": Scalar("boolean"),
        "lines": ListOf(Scalar("integer", min=0), min=1),
        "pay": Structure({"card": Scalar("string"), "cash": Scalar("double")}, union=True),
        "extra": MapOf(Scalar("integer"), Scalar("string", min=2)),
    },
    required=("key", "status", "pay"),
)


def _order_records(spark, d):
    """JSON orders; each status and priority breaks other rules."""
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    key = F.when(prio == "1-URGENT", F.concat(F.lit('"'), F.col("o_orderkey"), F.lit('"'))).otherwise(F.col("o_orderkey").cast("string"))
    pay = (
        F.when(prio == "2-HIGH", F.lit("{}"))
        .when(prio == "3-MEDIUM", F.lit('{"card":"v","cash":1.5}'))
        .otherwise(F.lit('{"card":"v"}'))
    )
    lines = F.when(status == "F", F.lit("[]")).when(status == "O", F.lit('[1,-1,"x"]')).otherwise(F.lit("null"))
    text = F.concat(
        F.lit('{"key":'), key, F.lit(',"price":'), F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        F.when(status != "P", F.concat(F.lit(',"status":"'), status, F.lit('"'))).otherwise(F.lit('')),
        F.lit(',"lines":'), lines, F.lit(',"pay":'), pay, F.lit(',"urgent":true,"extra":{"aa":1,"b":'),
        F.when(status == "F", F.lit("2")).otherwise(F.lit('"2"')), F.lit("}"),
        F.when(prio == "5-LOW", F.lit(',"note":1')).otherwise(F.lit("")), F.lit("}"),
    )
    return views.spread(views.table(spark, d, "orders")).select("o_orderkey", prio.alias("feed"), F.parse_json(text).alias("record"))


def dq_violations(spark, d):
    return quality.violation_rows(_order_records(spark, d), "record", ORDER_SHAPE, ["o_orderkey"])


def dq_report(spark, d):
    return quality.violation_report(dq_violations(spark, d))


def dq_all_any(spark, d):
    blank = F.transform(F.split("text", "\n"), lambda line: F.length(line) == 0)
    long = F.filter(F.split("text", "\n"), lambda line: F.length(line) > 200)
    return views.table(spark, d, "documents").select(
        "doc_id",
        quality.path_equals(F.col("lang"), "en").alias("is_english"),
        quality.path_all(blank, False).alias("no_blank"),
        quality.path_any(blank, True).alias("some_blank"),
        quality.path_all(F.transform(long, lambda line: F.startswith(line, F.lit("A"))), True).alias("long_all_a"),
    )


def dq_readiness(spark, d):
    return quality.readiness(views.table(spark, d, "conversations"), ["conv_id"], "role", "user")


def _items(spark, d):
    order = F.col("o_orderkey").cast("string")
    text = F.concat(
        F.lit('{"id":{"N":"'), order, F.lit('"},"status":{"S":"'), F.col("o_orderstatus"),
        F.lit('"},"paid":{"BOOL":'), (F.col("o_orderstatus") == "F").cast("string"),
        F.lit('},"price":{"N":"'), F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        F.lit('"},"none":{"NULL":true},"tags":{"SS":["a","'), F.col("o_orderpriority"), F.lit('","a"]},'),
        F.lit('"more":{"M":{"list":{"L":[{"N":"'), F.col("o_custkey").cast("string"), F.lit('"},{"S":"x"},{"NS":["1","1"]}]}}}}'),
    )
    return views.spread(views.table(spark, d, "orders")).select("o_orderkey", F.parse_json(text).alias("item"))


def tagged_flatten(spark, d):
    item = F.col("item")
    more = F.try_variant_get(item, "$.more", "variant")
    return _items(spark, d).select(
        "o_orderkey",
        tagged.attribute(item, "id", "number").cast("bigint").alias("id"),
        tagged.attribute(item, "status", "string").alias("status"),
        tagged.attribute(item, "paid", "boolean").alias("paid"),
        tagged.attribute(item, "price", "number_text").alias("price"),
        tagged.attribute(item, "none", "is_null").alias("none"),
        F.array_join(tagged.attribute(item, "tags", "string_set"), ",").alias("tags"),
        tagged.untag(more, 2).alias("more"),
    )


def tagged_export(spark, d):
    orders = views.table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        (F.col("o_orderstatus") == "F").alias("paid"),
        F.struct(F.array("o_orderpriority", "o_orderpriority").alias("list"), F.col("o_custkey").alias("customer")).alias("more"),
        F.array("o_custkey", "o_custkey").alias("ids"),
    )
    return tagged.tag_rows(orders, "item", sets=("ids",)).select("o_orderkey", "item")


QUERIES = {
    "ip_cidr_join": ip_cidr_join,
    "url_canonical": url_canonical,
    "url_parts": url_parts,
    "url_host_rollup": url_host_rollup,
    "dq_violations": dq_violations,
    "dq_report": dq_report,
    "dq_all_any": dq_all_any,
    "dq_readiness": dq_readiness,
    "tagged_flatten": tagged_flatten,
    "tagged_export": tagged_export,
}

_URL_PARTS = r"""u AS (
  SELECT page_id, html, regexp_extract(url, '^([a-z]+)://([^/]+)([^?#]*)(.*)$', 1) AS s,
         regexp_extract(url, '^([a-z]+)://([^/]+)([^?#]*)(.*)$', 2) AS h,
         regexp_extract(url, '^([a-z]+)://([^/]+)([^?#]*)(.*)$', 3) AS p,
         regexp_extract(url, '^([a-z]+)://([^/]+)([^?#]*)(.*)$', 4) AS q FROM pages)"""

_VIOLATIONS = """o AS (
  SELECT o_orderkey, o_orderstatus AS s, o_orderpriority AS p, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders),
v AS (
  SELECT o_orderkey, '.key' AS path, 'invalid type' AS reason, 'string' AS detail FROM o WHERE p = '1-URGENT'
  UNION ALL SELECT o_orderkey, '.key', 'invalid range', CAST(o_orderkey AS VARCHAR) FROM o WHERE p <> '1-URGENT' AND o_orderkey < 10
  UNION ALL SELECT o_orderkey, '', 'missing required field', 'status' FROM o WHERE s = 'P'
  UNION ALL SELECT o_orderkey, '.price', 'invalid range', regexp_replace(regexp_replace(CAST(price AS VARCHAR), '0+$', ''), '[.]$', '') FROM o WHERE price < 50000
  UNION ALL SELECT o_orderkey, '.lines', 'invalid length', '0' FROM o WHERE s = 'F'
  UNION ALL SELECT o_orderkey, '.lines', 'invalid type', 'null' FROM o WHERE s = 'P'
  UNION ALL SELECT o_orderkey, '.lines[1]', 'invalid range', '-1' FROM o WHERE s = 'O'
  UNION ALL SELECT o_orderkey, '.lines[2]', 'invalid type', 'string' FROM o WHERE s = 'O'
  UNION ALL SELECT o_orderkey, '.pay', 'empty input', NULL FROM o WHERE p = '2-HIGH'
  UNION ALL SELECT o_orderkey, '.pay', 'more than one input', NULL FROM o WHERE p = '3-MEDIUM'
  UNION ALL SELECT o_orderkey, '.extra (key: b)', 'invalid length', '"b"' FROM o
  UNION ALL SELECT o_orderkey, '.extra.b', 'invalid type', 'string' FROM o WHERE s <> 'F'
  UNION ALL SELECT o_orderkey, '', 'unknown field', 'note' FROM o WHERE p = '5-LOW')"""

SQL = {
    "ip_cidr_join": f"""WITH {EVENT_STATS},
b AS (
  SELECT n_name AS label, 10 * 16777216 + (n_nationkey % 3) * 65536 AS lo, 65536 AS size FROM nation
  UNION ALL SELECT n_name, 10 * 16777216 + (n_nationkey % 4) * 65536 + (n_nationkey % 7) * 256, 256 FROM nation
  UNION ALL SELECT n_name, 10 * 16777216 + (n_nationkey % 4) * 65536 + (n_nationkey % 7) * 256 + (n_nationkey * 10) // 8 * 8, 8 FROM nation),
i AS (
  SELECT DISTINCT ip, CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
         + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) AS n FROM event_stats),
m AS (
  SELECT ip, label FROM i JOIN b ON n >= lo AND n < lo + size
  QUALIFY row_number() OVER (PARTITION BY ip ORDER BY size, label DESC) = 1)
SELECT e.media_id, e.visitor_key, e.ip, m.label FROM event_stats e LEFT JOIN m ON m.ip = e.ip""",
    "url_canonical": f"""WITH {_URL_PARTS}
SELECT page_id, CASE length(html) % 4 WHEN 0 THEN s || '://' || h || p || q
       WHEN 1 THEN s || '://' || h || p || q
       WHEN 2 THEN s || '://User%3A@' || h || ':80' || p || '/a%20b%7E' || q END AS canonical FROM u""",
    "url_parts": f"""WITH {_URL_PARTS}
SELECT page_id, s AS scheme, CAST(NULL AS VARCHAR) AS auth, h AS host, CAST(NULL AS INTEGER) AS port, p AS path,
       nullif(regexp_extract(q, '[?]([^#]*)', 1), '') AS query, nullif(regexp_extract(q, '#(.*)', 1), '') AS fragment FROM u""",
    "url_host_rollup": """SELECT regexp_extract(url, '://([^/]+)', 1) AS host, count(*) AS pages,
       count(DISTINCT url) AS urls, count(*) FILTER (WHERE starts_with(url, 'https:')) AS secure
FROM pages GROUP BY 1""",
    "dq_violations": f"WITH {_VIOLATIONS} SELECT * FROM v",
    "dq_report": f"""WITH {_VIOLATIONS}
SELECT regexp_replace(path, '[[][0-9]+[]]', '[]') AS path, reason, count(*) AS violations FROM v GROUP BY 1, 2""",
    "dq_all_any": """WITH t AS (
  SELECT doc_id, lang, string_split(text, chr(10)) AS l FROM documents),
x AS (SELECT *, list_filter(l, lambda a: length(a) > 200) AS big FROM t)
SELECT doc_id, lang = 'en' AS is_english, NOT list_contains(l, '') AS no_blank, list_contains(l, '') AS some_blank,
       len(big) > 0 AND len(list_filter(big, lambda a: NOT starts_with(a, 'A'))) = 0 AS long_all_a FROM x""",
    "dq_readiness": """SELECT conv_id, bool_and(role = 'user') AS all_equal, bool_or(role = 'user') AS any_equal
FROM conversations GROUP BY conv_id""",
    "tagged_flatten": """SELECT o_orderkey, o_orderkey AS id, o_orderstatus AS status, o_orderstatus = 'F' AS paid,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price, true AS "none", 'a,' || o_orderpriority AS tags,
       '{"list":[' || o_custkey || ',"x",[1]]}' AS more FROM orders""",
    "tagged_export": """SELECT o_orderkey, '{"o_orderkey":{"N":"' || o_orderkey || '"},"status":' ||
       CASE WHEN o_orderstatus = 'P' THEN '{"NULL":true}' ELSE '{"S":"' || o_orderstatus || '"}' END ||
       ',"price":{"N":"' || CAST(o_totalprice AS DECIMAL(12,2)) || '"},"paid":{"BOOL":' ||
       CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END || '},"more":{"M":{"list":{"L":[{"S":"' ||
       o_orderpriority || '"},{"S":"' || o_orderpriority || '"}]},"customer":{"N":"' || o_custkey ||
       '"}}},"ids":{"NS":["' || o_custkey || '"]}}' AS item FROM orders""",
}
