"""Records with drifting types, over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewloom.operators import drift, flatten
from viewloom.plans import views


def _drifting(spark, d):
    """Events whose ``k`` is a number, a text, an object or a list by their type, whose ``in.v`` is a number
    or a text, and some of which lack a member."""
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k")
    shape = (
        F.when(kind == "view", k)
        .when(kind == "click", F.concat(F.lit('"k'), k, F.lit('"')))
        .when(kind == "error", F.concat(F.lit('{"n":'), k, F.lit("}")))
        .when(kind == "signup", F.concat(F.lit("["), k, F.lit(",1]")))
    )
    member = F.when(shape.isNotNull(), F.concat(F.lit(',"k":'), shape)).otherwise("")
    inner = F.when(F.col("event_id") % 3 == 0, F.lit('"x"')).when(F.col("event_id") % 3 == 1, k).otherwise(F.lit("null"))
    size = F.when(F.col("event_id") % 2 == 0, k).otherwise(F.concat(k, F.lit(".5")))
    text = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), member, F.lit(',"in":{"v":'), inner, F.lit(',"s":"t"},"size":'), size, F.lit("}"))
    return views.table(spark, d, "events").select(F.parse_json(text).alias("record"))


def drift_types(spark, d):
    return drift.type_counts(_drifting(spark, d), "record")


def drift_choices(spark, d):
    rows = flatten.flatten_structs(drift.resolve(_drifting(spark, d), "record", []), "_")
    return rows.withColumn("size", F.col("size").cast("double"))


def drift_projected(spark, d):
    how = {"k": "project:long", "in.v": "json"}
    rows = flatten.flatten_structs(drift.resolve(_drifting(spark, d), "record", [], how), "_")
    return rows.select("id", "k", "in_v", "in_s")


QUERIES = {"drift_types": drift_types, "drift_choices": drift_choices, "drift_projected": drift_projected}

_E = """e AS (SELECT event_id AS id, event_type AS t, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""

SQL = {
    "drift_types": f"""WITH {_E}, v AS (
  SELECT 'id' AS path, 'integer' AS kind FROM e
  UNION ALL SELECT 'in', 'object' FROM e UNION ALL SELECT 'in.s', 'string' FROM e
  UNION ALL SELECT 'in.v', ['string', 'integer', 'null'][id % 3 + 1] FROM e
  UNION ALL SELECT 'size', CASE WHEN id % 2 = 0 THEN 'integer' ELSE 'fraction' END FROM e
  UNION ALL SELECT 'k', CASE t WHEN 'view' THEN 'integer' WHEN 'click' THEN 'string' WHEN 'error' THEN 'object' ELSE 'array' END FROM e WHERE t <> 'purchase')
SELECT path, kind, count(*) AS rows FROM v GROUP BY path, kind""",
    "drift_choices": f"""WITH {_E}
SELECT id, CASE WHEN t = 'view' THEN k END AS k_long, CASE WHEN t = 'click' THEN 'k' || k END AS k_string,
       CASE WHEN t = 'signup' THEN '[' || k || ',1]' END AS k_list, CASE WHEN t = 'error' THEN '{{"n":' || k || '}}' END AS k_object,
       CASE WHEN id % 3 = 1 THEN k END AS in_v_long, CASE WHEN id % 3 = 0 THEN 'x' END AS in_v_string, 't' AS in_s,
       CAST(CASE WHEN id % 2 = 0 THEN k ELSE k + 0.5 END AS DOUBLE) AS size FROM e""",
    "drift_projected": f"""WITH {_E}
SELECT id, CASE WHEN t = 'view' THEN k END AS k, CASE id % 3 WHEN 0 THEN '"x"' WHEN 1 THEN CAST(k AS VARCHAR) ELSE 'null' END AS in_v, 't' AS in_s FROM e""",
}
