"""Predicate, page-merge, upsert and record-patch queries over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from viewloom.functions import predicates as p
from viewloom.operators import merge
from viewloom.plans import views

MAX_ITEMS = 150


def pred_compare(spark, d):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return views.table(spark, d, "orders").select(
        "o_orderkey",
        (status == "F").alias("eq"),
        (status != "F").alias("ne"),
        (price < 100000).alias("lt"),
        (price <= 250000).alias("lte"),
        (price > 100000).alias("gt"),
        (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).alias("gte"),
        price.between(100000, 200000).alias("in_range"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("in_list"),
    )


def pred_string(spark, d):
    text, lines = F.col("text"), F.split("text", "\n")
    return views.table(spark, d, "documents").select(
        "doc_id",
        p.begins_with(text, "A").alias("begins"),
        p.contains(text, "tion", StringType()).alias("has"),
        p.contains(lines, "", ArrayType(StringType())).alias("has_blank_line"),
        (p.size_of(text, StringType()) > 2000).alias("is_long"),
        (p.size_of(lines, ArrayType(StringType())) <= 5).alias("few_lines"),
    )


def pred_exists(spark, d):
    """Items have different keys by event type; one has an explicit null."""
    kind = F.col("event_type")
    item = (
        F.when(kind == "view", F.concat(F.lit('{"k":'), F.get_json_object("props", "$.k"), F.lit(',"n":null}')))
        .when(kind == "click", F.lit('{"n":"x"}'))
        .when(kind == "error", F.lit('{"n":[1],"m":{}}'))
        .otherwise(F.lit('{"flag":true}'))
    )
    events = views.table(spark, d, "events").withColumn("item", F.parse_json(item))
    return events.select(
        "event_id",
        p.attribute_exists(F.col("item"), "n").alias("has_n"),
        p.attribute_not_exists(F.col("item"), "k").alias("no_k"),
        p.attribute_type(F.col("item"), "n").alias("type_n"),
        p.attribute_type(F.col("item"), "k").alias("type_k"),
        p.attribute_type(F.col("item"), "flag").alias("type_flag"),
    )


def pred_boolean(spark, d):
    cheap, urgent = F.col("o_totalprice") < 150000, F.col("o_orderpriority") == "1-URGENT"
    done, busy = F.col("o_orderstatus") == "F", F.col("o_custkey") > 100
    return views.table(spark, d, "orders").filter(
        p.any_of(p.all_of(cheap, urgent, ~done), p.all_of(done, ~p.any_of(cheap, ~busy)))
    ).select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")


def _pages(spark, d):
    return views.table(spark, d, "conversations").select(
        "conv_id",
        "turn",
        F.split("text", " ").alias("words"),
        F.length("text").cast("bigint").alias("chars"),
        "role",
        "text",
    )


def merge_pages(spark, d):
    return merge.merge_pages(_pages(spark, d), ["conv_id"], "turn", ["chars"], ["role", "text"])


def merge_pages_items(spark, d):
    merged = merge.merge_page_items(_pages(spark, d), ["conv_id"], "turn", "words", segment=64)
    return merged.select("conv_id", "segment", F.array_join("words", " ").alias("words"))


def merge_pages_text(spark, d):
    return merge.merge_page_text(_pages(spark, d), ["conv_id"], "turn", "text", segment=500)


def _sources(spark, d):
    return views.table(spark, d, "documents").select("source", "doc_id", F.split("text", "\n").alias("lines"))


def page_limit(spark, d):
    kept = merge.limit_pages(_sources(spark, d), ["source"], "doc_id", "lines", MAX_ITEMS)
    return kept.select(
        "source", "doc_id", F.size("lines").cast("bigint").alias("n"), F.md5(F.array_join("lines", "|")).alias("digest")
    )


def page_limit_resume(spark, d):
    """Everything after the cap: the rest of the cut page and all later pages."""
    pages = _sources(spark, d)
    positions = merge.resume_position(pages, ["source"], "doc_id", "lines", MAX_ITEMS)
    rest = merge.resume_pages(pages, positions, ["source"], "doc_id", "lines")
    return rest.select(
        "source",
        "doc_id",
        "skipped",
        F.size("lines").cast("bigint").alias("n"),
        F.md5(F.array_join("lines", "|")).alias("digest"),
    )


def _changes(spark, d):
    return views.table(spark, d, "events").select(
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", "delete").otherwise("put").alias("op"),
        F.col("value").alias("payload"),
    )


def upsert_last_write(spark, d):
    return merge.upsert_last_write(_changes(spark, d), ["user_id", "k"], "seq")


def _patches(spark, d):
    """Sparse patches per user. Errors turn the settings object into a scalar,
    signups put an empty object back, clicks and views write into it."""
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    settings = (
        F.when(kind == "error", F.lit('"off"'))
        .when(kind == "signup", F.lit("{}"))
        .when(kind == "click", F.concat(F.lit('{"theme":{"size":'), k, F.lit("}}")))
        .when(kind == "view", F.concat(F.lit('{"seen":'), k, F.lit(',"tags":["a",'), k, F.lit("]}")))
        .otherwise(F.lit("null"))
    )
    doc = F.concat(
        F.lit('{"settings":'), settings, F.lit(',"by/type":{"'), kind, F.lit('":'), k,
        F.lit('},"log":'), F.when(kind == "purchase", F.lit("0")).otherwise(F.concat(F.lit("["), k, F.lit(",-1]"))),
        F.lit("}"),
    )
    return views.spread(views.table(spark, d, "events")).select(
        "user_id", F.col("event_id").alias("seq"), doc.alias("doc")
    )


def record_patch_fold(spark, d):
    return merge.fold_patches(_patches(spark, d), ["user_id"], "seq", "doc")


def record_patch_append(spark, d):
    appended = merge.append_list_patches(_patches(spark, d), ["user_id"], "seq", "doc")
    return appended.select("user_id", "path", "seq", F.col("pos").cast("bigint").alias("pos"), "value")


QUERIES = {
    "pred_compare": pred_compare,
    "pred_string": pred_string,
    "pred_exists": pred_exists,
    "pred_boolean": pred_boolean,
    "merge_pages": merge_pages,
    "merge_pages_items": merge_pages_items,
    "merge_pages_text": merge_pages_text,
    "page_limit": page_limit,
    "page_limit_resume": page_limit_resume,
    "upsert_last_write": upsert_last_write,
    "record_patch_fold": record_patch_fold,
    "record_patch_append": record_patch_append,
}

_SOURCE_PAGES = """p AS (
  SELECT source, doc_id, string_split(text, chr(10)) AS lines FROM documents),
c AS (
  SELECT *, CAST(sum(len(lines)) OVER (PARTITION BY source ORDER BY doc_id) - len(lines) AS BIGINT) AS before
  FROM p)"""

SQL = {
    "pred_compare": """SELECT o_orderkey, o_orderstatus = 'F' AS eq, o_orderstatus <> 'F' AS ne,
       o_totalprice < 100000 AS lt, o_totalprice <= 250000 AS lte, o_totalprice > 100000 AS gt,
       o_orderdate >= TIMESTAMP '1998-01-01' AS gte, o_totalprice BETWEEN 100000 AND 200000 AS in_range,
       o_orderpriority IN ('1-URGENT', '2-HIGH') AS in_list FROM orders""",
    "pred_string": """SELECT doc_id, starts_with(text, 'A') AS begins, contains(text, 'tion') AS has,
       list_contains(string_split(text, chr(10)), '') AS has_blank_line, length(text) > 2000 AS is_long,
       len(string_split(text, chr(10))) <= 5 AS few_lines FROM documents""",
    "pred_exists": """SELECT event_id, event_type IN ('view', 'click', 'error') AS has_n, event_type <> 'view' AS no_k,
       CASE event_type WHEN 'view' THEN 'NULL' WHEN 'click' THEN 'S' WHEN 'error' THEN 'L' END AS type_n,
       CASE event_type WHEN 'view' THEN 'N' END AS type_k,
       CASE WHEN event_type IN ('signup', 'purchase') THEN 'BOOL' END AS type_flag FROM events""",
    "pred_boolean": """SELECT o_orderkey, o_totalprice, o_orderpriority, o_orderstatus FROM orders
WHERE (o_totalprice < 150000 AND o_orderpriority = '1-URGENT' AND NOT o_orderstatus = 'F')
   OR (o_orderstatus = 'F' AND NOT (o_totalprice < 150000 OR NOT o_custkey > 100))""",
    "merge_pages": """SELECT conv_id, count(*) AS pages, CAST(sum(length(text)) AS BIGINT) AS chars,
       arg_min(role, turn) AS role, arg_min(text, turn) AS text FROM conversations GROUP BY conv_id""",
    "merge_pages_items": """WITH w AS (
  SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word,
         generate_subscripts(string_split(text, ' '), 1) AS i FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, i) - 1 AS pos FROM w)
SELECT conv_id, pos // 64 AS segment, string_agg(word, ' ' ORDER BY pos) AS words FROM n GROUP BY conv_id, segment""",
    "merge_pages_text": """WITH a AS (
  SELECT conv_id, string_agg(text, '' ORDER BY turn) AS t FROM conversations GROUP BY conv_id)
SELECT conv_id, s AS segment, t[s * 500 + 1:(s + 1) * 500] AS text
FROM (SELECT conv_id, t, unnest(range((length(t) + 499) // 500)) AS s FROM a)""",
    "page_limit": f"""WITH {_SOURCE_PAGES}
SELECT source, doc_id, least(len(lines), {MAX_ITEMS} - before) AS n,
       md5(array_to_string(lines[1:{MAX_ITEMS} - before], '|')) AS digest FROM c WHERE before < {MAX_ITEMS}""",
    "page_limit_resume": f"""WITH {_SOURCE_PAGES}, s AS (
  SELECT *, greatest({MAX_ITEMS} - before, 0) AS skipped FROM c)
SELECT source, doc_id, skipped, len(lines) - skipped AS n,
       md5(array_to_string(lines[skipped + 1:], '|')) AS digest FROM s WHERE len(lines) > skipped""",
    "upsert_last_write": """WITH c AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id AS seq, event_type,
         value AS payload FROM events)
SELECT user_id, k, seq, payload FROM (
  SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY user_id, k ORDER BY seq DESC) = 1)
WHERE event_type <> 'error'""",
    "record_patch_fold": """WITH e AS (
  SELECT user_id, event_id AS seq, event_type AS t, json_extract_string(props, '$.k') AS k FROM events),
reset AS (
  SELECT user_id, max(seq) AS at, arg_max(t, seq) AS t FROM e WHERE t IN ('error', 'purchase') GROUP BY user_id),
live AS (
  SELECT e.* FROM e LEFT JOIN reset r ON r.user_id = e.user_id WHERE r.at IS NULL OR e.seq > r.at),
tags AS (
  SELECT user_id, '/settings/theme/size' AS path, arg_max(k, seq) AS value FROM live WHERE t = 'click' GROUP BY user_id
  UNION ALL SELECT user_id, '/settings/seen', arg_max(k, seq) FROM live WHERE t = 'view' GROUP BY user_id
  UNION ALL SELECT user_id, '/settings/tags', '["a",' || arg_max(k, seq) || ']' FROM live WHERE t = 'view' GROUP BY user_id)
SELECT * FROM tags
UNION ALL SELECT user_id, '/settings', '{}' FROM live WHERE t = 'signup'
  AND user_id NOT IN (SELECT user_id FROM tags) GROUP BY user_id
UNION ALL SELECT user_id, '/settings', CASE r.t WHEN 'error' THEN '"off"' ELSE 'null' END FROM reset r
  WHERE user_id NOT IN (SELECT user_id FROM live)
UNION ALL SELECT user_id, '/by~1type/' || t, arg_max(k, seq) FROM e GROUP BY user_id, t
UNION ALL SELECT user_id, '/log', CASE arg_max(t, seq) WHEN 'purchase' THEN '0'
  ELSE '[' || arg_max(k, seq) || ',-1]' END FROM e GROUP BY user_id""",
    "record_patch_append": """WITH e AS (
  SELECT user_id, event_id AS seq, event_type AS t, json_extract_string(props, '$.k') AS k FROM events),
restart AS (SELECT user_id, max(seq) AS at FROM e WHERE t = 'purchase' GROUP BY user_id),
el AS (
  SELECT user_id, '/log' AS path, seq, t, CAST(n AS BIGINT) AS pos, CASE n WHEN 0 THEN k ELSE '-1' END AS value
  FROM e, range(2) r(n) WHERE t <> 'purchase')
SELECT el.user_id, el.path, el.seq, el.pos, el.value FROM el LEFT JOIN restart r ON r.user_id = el.user_id
WHERE r.at IS NULL OR el.seq > r.at""",
}
