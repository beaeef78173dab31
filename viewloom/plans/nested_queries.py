"""Nested-value queries over the supplied tables.

Arrays are made row by row (the lines of a document, the numbers of an
embedding), so no group is ever collected.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, VariantType

from viewloom.functions import nested
from viewloom.plans import views


def _lines(spark, d):
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            i.cast("bigint").alias("pos"),
            line.alias("text"),
            F.length(line).cast("bigint").alias("n"),
        ),
    )
    return views.spread(views.table(spark, d, "documents")).select("doc_id", "lang", "source", lines.alias("lines"))


def _digest(strings):
    return F.md5(F.array_join(strings, "|"))


def nested_path(spark, d):
    body = F.parse_json(
        F.to_json(F.struct(F.struct("lang", "source").alias("meta"), F.col("lines").alias("lines")))
    )
    df = _lines(spark, d).withColumn("body", body)
    lines = F.col("lines")
    return df.select(
        "doc_id",
        nested.variant_path(F.col("body"), "$.meta.lang", "string").alias("lang"),
        nested.variant_path(F.col("body"), "$.lines[1].n", "bigint").alias("second_n"),
        nested.variant_path(F.col("body"), "$.meta.missing", "string").alias("missing"),
        nested.element(lines, 0)["n"].alias("first_n"),
        nested.element(lines, -1)["n"].alias("last_n"),
        nested.element(lines, -3)["n"].alias("third_last_n"),
        nested.element(lines, 9)["n"].alias("tenth_n"),
    )


def nested_slice(spark, d):
    sizes = F.transform("lines", lambda x: x["n"].cast("string"))
    cuts = {
        "head": (None, 3, 1),
        "tail": (-3, None, 1),
        "middle": (1, -1, 1),
        "odd": (1, None, 2),
        "backwards": (None, None, -1),
        "back_two": (5, 0, -2),
    }
    return _lines(spark, d).select(
        "doc_id",
        *[F.array_join(nested.slice_steps(sizes, *cut), ",").alias(name) for name, cut in cuts.items()],
    )


def nested_projection(spark, d):
    return _lines(spark, d).select(
        "doc_id",
        F.array_join(
            nested.project(F.col("lines"), lambda x: F.when(x["n"] % 2 == 0, x["n"]).cast("string")), ","
        ).alias("even_sizes"),
        F.array_join(
            nested.project_values(
                F.create_map(F.lit("a"), F.col("lang"), F.lit("b"), F.when(F.col("source") > "src15", F.col("source")))
            ),
            ",",
        ).alias("map_values"),
    )


def nested_filter(spark, d):
    lines = F.col("lines")
    return _lines(spark, d).select(
        "doc_id",
        F.size(nested.filter_project(lines, lambda x: x["n"] >= 80)).cast("bigint").alias("long_lines"),
        _digest(
            nested.filter_project(
                lines,
                lambda x: ((x["n"] > 40) & x["text"].contains("an")) | (x["pos"] == 0),
                lambda x: x["text"],
            )
        ).alias("chosen"),
        F.size(nested.filter_project(lines, lambda x: nested.negate(x["text"], StringType())))
        .cast("bigint")
        .alias("blank_lines"),
    )


def nested_flatten(spark, d):
    words = nested.flatten_once(F.transform("lines", lambda x: F.split(x["text"], " ")))
    return _lines(spark, d).select(
        "doc_id", F.size(words).cast("bigint").alias("words"), _digest(words).alias("digest")
    )


def nested_multiselect(spark, d):
    third = nested.element(F.col("lines"), 2)
    df = _lines(spark, d).select(
        "doc_id",
        nested.select_list(third, third["n"].cast("string"), F.col("lang")).alias("pair"),
        nested.select_object(third, size=third["n"], lang=F.col("lang"), none=F.lit(None).cast("string")).alias("obj"),
    )
    return df.select(
        "doc_id",
        F.array_join("pair", ":").alias("pair"),
        F.col("obj.size").alias("size"),
        F.col("obj").isNull().alias("absent"),
    )


def nested_array_agg(spark, d):
    vec = F.transform("embedding", lambda x: x.cast("double"))
    positive = F.filter(vec, lambda x: x > 0.2)
    return views.table(spark, d, "embeddings").select(
        "vec_id",
        F.round(nested.array_sum(vec), 6).alias("total"),
        F.round(nested.array_avg(vec), 6).alias("mean"),
        F.array_min(vec).alias("low"),
        F.array_max(vec).alias("high"),
        F.round(nested.array_sum(positive), 6).alias("positive_total"),
        F.round(nested.array_avg(positive), 6).alias("positive_mean"),
    )


def nested_sort_by(spark, d):
    by_size = nested.sort_by(F.col("lines"), lambda x: x["n"])
    return _lines(spark, d).select(
        "doc_id",
        F.array_join(F.transform(by_size, lambda x: x["pos"].cast("string")), ",").alias("order"),
        F.array_join(F.transform(F.array_sort(F.transform("lines", lambda x: x["n"])), lambda x: x.cast("string")), ",").alias("sizes"),
    )


def nested_max_by(spark, d):
    lines = F.col("lines")
    tens = lambda x: F.floor(x["n"] / 10)  # coarse key, so ties occur
    return _lines(spark, d).select(
        "doc_id",
        nested.max_by(lines, tens)["pos"].alias("longest"),
        nested.min_by(lines, tens)["pos"].alias("shortest"),
    )


def nested_string_fns(spark, d):
    text = F.element_at("lines", 1)["text"]
    sizes = F.transform("lines", lambda x: x["n"])
    return _lines(spark, d).select(
        "doc_id",
        F.length(text).cast("bigint").alias("length"),
        F.size("lines").cast("bigint").alias("lines_length"),
        F.md5(F.reverse(text)).alias("reversed"),
        F.array_join(F.transform(F.reverse(sizes), lambda x: x.cast("string")), ",").alias("sizes_reversed"),
        nested.contains(text, F.lit("the"), StringType()).alias("has_the"),
        nested.contains(sizes, F.lit(0).cast("bigint"), None).alias("has_blank"),
        text.startswith("A").alias("starts_a"),
        text.endswith(".").alias("ends_dot"),
    )


def nested_merge(spark, d):
    base = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    patch = F.create_map(F.lit("source"), F.upper("source"), F.lit("size"), F.size("lines").cast("string"))
    merged = nested.merge(base, patch)
    return _lines(spark, d).select(
        "doc_id",
        F.array_join(F.array_sort(F.map_keys(merged)), ",").alias("keys"),
        F.array_join(F.array_sort(F.map_values(merged)), ",").alias("values"),
        merged["source"].alias("source"),
    )


def _mixed(spark, d):
    """One JSON value of each type per event, chosen by the event type."""
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.concat(F.lit('"'), k, F.lit('"')))
        .when(kind == "click", k)
        .when(kind == "error", F.concat(F.lit("[1,"), k, F.lit("]")))
        .when(kind == "signup", F.lit("true"))
        .when(F.col("value") < 20, F.lit("null"))
        .otherwise(F.lit('"n/a"'))
    )
    return views.table(spark, d, "events").withColumn("v", F.parse_json(text))


def nested_cast_fns(spark, d):
    v = F.col("v")
    return _mixed(spark, d).select(
        "event_id",
        nested.type_name(v).alias("type"),
        nested.as_string(v).alias("to_string"),
        nested.as_number(v).alias("to_number"),
        F.size(nested.as_list(v)).cast("bigint").alias("list_size"),
        nested.truthy(v, VariantType()).alias("truth"),
        nested.compare_variant(v, ">=", F.parse_json(F.lit("50"))).alias("at_least_50"),
        F.coalesce(nested.as_number(v), F.lit(-1.0)).alias("not_null"),
        F.abs(F.lit(-1.5) * F.col("value")).alias("abs"),
        F.ceil("value").alias("ceil"),
        F.floor("value").alias("floor"),
    )


def page_flatmap(spark, d):
    page = F.parse_json(F.to_json(F.struct(F.col("event_id"), F.struct("v").alias("body"))))
    pages = _mixed(spark, d).select("event_id", page.alias("page"))
    return pages.select(
        "event_id", F.explode(nested.flat_map(F.col("page"), "$.body.v")).alias("item")
    ).select("event_id", nested.as_string(F.col("item")).alias("item"))


QUERIES = {
    "nested_path": nested_path,
    "nested_slice": nested_slice,
    "nested_projection": nested_projection,
    "nested_filter": nested_filter,
    "nested_flatten": nested_flatten,
    "nested_multiselect": nested_multiselect,
    "nested_array_agg": nested_array_agg,
    "nested_sort_by": nested_sort_by,
    "nested_max_by": nested_max_by,
    "nested_string_fns": nested_string_fns,
    "nested_merge": nested_merge,
    "nested_cast_fns": nested_cast_fns,
    "page_flatmap": page_flatmap,
}

_LINES = """docs AS (
  SELECT doc_id, lang, source, text, string_split(text, chr(10)) AS t,
         list_transform(string_split(text, chr(10)), lambda l: length(l)) AS n
  FROM documents)"""

_MIXED = """mixed AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""

SQL = {
    "nested_path": f"""WITH {_LINES}
SELECT doc_id, lang, CAST(n[2] AS BIGINT) AS second_n, CAST(NULL AS VARCHAR) AS missing,
       n[1] AS first_n, n[-1] AS last_n, n[-3] AS third_last_n, n[10] AS tenth_n FROM docs""",
    "nested_slice": f"""WITH {_LINES}
SELECT doc_id, array_to_string(n[1:3], ',') AS head,
       array_to_string(list_filter(n, lambda x, i: i > len(n) - 3), ',') AS tail,
       array_to_string(list_filter(n, lambda x, i: i > 1 AND i < len(n)), ',') AS middle,
       array_to_string(list_filter(n, lambda x, i: i % 2 = 0), ',') AS odd,
       array_to_string(list_reverse(n), ',') AS backwards,
       array_to_string(list_reverse(list_filter(n, lambda x, i:
           i <= 6 AND i > 1 AND (least(len(n), 6) - i) % 2 = 0)), ',') AS back_two
FROM docs""",
    "nested_projection": f"""WITH {_LINES}
SELECT doc_id, array_to_string(list_filter(n, lambda x: x % 2 = 0), ',') AS even_sizes,
       concat_ws(',', lang, CASE WHEN source > 'src15' THEN source END) AS map_values FROM docs""",
    "nested_filter": f"""WITH {_LINES}
SELECT doc_id, len(list_filter(n, lambda x: x >= 80)) AS long_lines,
       md5(array_to_string(list_filter(t, lambda x, i:
           (length(x) > 40 AND contains(x, 'an')) OR i = 1), '|')) AS chosen,
       len(list_filter(n, lambda x: x = 0)) AS blank_lines FROM docs""",
    "nested_flatten": f"""WITH {_LINES}, w AS (
  SELECT doc_id, flatten(list_transform(t, lambda x: string_split(x, ' '))) AS words FROM docs)
SELECT doc_id, len(words) AS words, md5(array_to_string(words, '|')) AS digest FROM w""",
    "nested_multiselect": f"""WITH {_LINES}
SELECT doc_id, n[3] || ':' || lang AS pair, n[3] AS size, n[3] IS NULL AS absent FROM docs""",
    "nested_array_agg": """WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
p AS (SELECT *, list_filter(v, lambda x: x > 0.2) AS pos FROM e)
SELECT vec_id, round(list_sum(v), 6) AS total, round(list_avg(v), 6) AS mean, list_min(v) AS low,
       list_max(v) AS high, round(coalesce(list_sum(pos), 0.0), 6) AS positive_total,
       round(list_avg(pos), 6) AS positive_mean FROM p""",
    "nested_sort_by": f"""WITH {_LINES}, s AS (
  SELECT doc_id, n, list_sort(list_transform(n, lambda x, i: {{'k': x, 'i': i - 1}})) AS r FROM docs)
SELECT doc_id, array_to_string(list_transform(r, lambda x: x.i), ',') AS order,
       array_to_string(list_sort(n), ',') AS sizes FROM s""".replace("AS order", 'AS "order"'),
    "nested_max_by": f"""WITH {_LINES}, s AS (
  SELECT doc_id, list_transform(n, lambda x, i: {{'k': x // 10, 'i': -(i - 1)}}) AS hi,
         list_transform(n, lambda x, i: {{'k': x // 10, 'i': i - 1}}) AS lo FROM docs)
SELECT doc_id, -(list_max(hi).i) AS longest, list_min(lo).i AS shortest FROM s""",
    "nested_string_fns": f"""WITH {_LINES}
SELECT doc_id, length(t[1]) AS length, len(t) AS lines_length, md5(reverse(t[1])) AS reversed,
       array_to_string(list_reverse(n), ',') AS sizes_reversed, contains(t[1], 'the') AS has_the,
       list_contains(n, 0) AS has_blank, starts_with(t[1], 'A') AS starts_a, ends_with(t[1], '.') AS ends_dot
FROM docs""",
    "nested_merge": f"""WITH {_LINES}
SELECT doc_id, 'lang,size,source' AS keys,
       array_to_string(list_sort([lang, upper(source), CAST(len(t) AS VARCHAR)]), ',') AS values,
       upper(source) AS source FROM docs""".replace("AS values", 'AS "values"'),
    "nested_cast_fns": f"""WITH {_MIXED}
SELECT event_id,
       CASE event_type WHEN 'view' THEN 'string' WHEN 'click' THEN 'number' WHEN 'error' THEN 'array'
            WHEN 'signup' THEN 'boolean' ELSE CASE WHEN value < 20 THEN 'null' ELSE 'string' END
       END AS type,
       CASE event_type WHEN 'error' THEN '[1,' || k || ']' WHEN 'signup' THEN 'true'
            WHEN 'purchase' THEN CASE WHEN value < 20 THEN 'null' ELSE 'n/a' END
            ELSE CAST(k AS VARCHAR) END AS to_string,
       CASE WHEN event_type IN ('view', 'click') THEN CAST(k AS DOUBLE) END AS to_number,
       CAST(CASE event_type WHEN 'error' THEN 2 ELSE 1 END AS BIGINT) AS list_size,
       NOT (event_type = 'purchase' AND value < 20) AS truth,
       CASE WHEN event_type = 'click' THEN k >= 50 END AS at_least_50,
       CASE WHEN event_type IN ('view', 'click') THEN CAST(k AS DOUBLE) ELSE -1.0 END AS not_null,
       abs(-1.5::DOUBLE * value) AS abs, CAST(ceil(value) AS BIGINT) AS ceil, CAST(floor(value) AS BIGINT) AS floor
FROM mixed""",
    "page_flatmap": f"""WITH {_MIXED}
SELECT event_id, CASE event_type WHEN 'error' THEN CASE n WHEN 0 THEN '1' ELSE CAST(k AS VARCHAR) END
       WHEN 'signup' THEN 'true'
       WHEN 'purchase' THEN CASE WHEN value < 20 THEN 'null' ELSE 'n/a' END
       ELSE CAST(k AS VARCHAR) END AS item
FROM mixed, range(2) r(n) WHERE n = 0 OR event_type = 'error'""",
}
