"""Landing, conversion, flattening and snapshot queries over the supplied tables."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.operators import flatten, incremental
from viewloom.plans import jobs, views
from viewloom.plans.star_queries import SQL as STAR_SQL
from viewloom.plans.views import EVENT_STATS, MEDIA_SHOW
from viewloom.session import scratch_path
from viewloom.sources import catalog, files, manifest, raw_json, sinks
from viewloom.streaming import convert

WATERMARK = "2024-01-15 12:00:00"


def _documents(spark, d):
    """One landed document per event: a list, an object, a broken file, an empty
    list or a scalar, depending on the event type."""
    event_id = F.col("event_id").cast("string")
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    obj = F.concat(F.lit('{"id":'), event_id, F.lit(',"k":'), k, F.lit("}"))
    listed = F.concat(
        F.lit('[{"id":'), event_id, F.lit(',"k":'), k, F.lit(',"n":null},'), obj, F.lit(',"12","abc",null]')
    )
    document = (
        F.when(kind == "view", listed)
        .when(kind == "click", obj)
        .when(kind == "error", F.concat(F.lit('{"id":'), event_id, F.lit(',"k":')))
        .when(kind == "signup", F.lit("[]"))
        .otherwise(k)
    )
    return views.spread(views.table(spark, d, "events")).select(
        "event_id",
        kind.alias("kind"),
        F.concat(F.lit("/zone/raw/"), kind, F.lit("/"), event_id, F.lit(".part.json")).alias("source_path"),
        document.alias("document"),
    )


def raw_json_records(spark, d):
    records = raw_json.explode_records(raw_json.parse_documents(_documents(spark, d)))
    return records.select(
        "source_path",
        F.col("record_no").cast("bigint").alias("record_no"),
        F.try_variant_get("record", "$.id", "bigint").alias("id"),
        F.coalesce(
            F.try_variant_get("record", "$.k", "bigint"),
            F.when(F.schema_of_variant("record") == "BIGINT", F.try_variant_get("record", "$", "bigint")),
        ).alias("k"),
        F.when(F.schema_of_variant("record") == "STRING", F.try_variant_get("record", "$", "string")).alias("text"),
        F.is_variant_null("record").alias("nothing"),
    )


def raw_to_jsonl(spark, d):
    return raw_json.to_lines(_documents(spark, d)).select("source_path", "target_path", "line")


def backfill_quarantine(spark, d):
    return raw_json.conversion_log(_documents(spark, d))


def run_metrics(spark, d):
    return raw_json.run_metrics(raw_json.conversion_log(_documents(spark, d)))


def event_time_normalize(spark, d):
    """Times arrive as text under one of two keys, with Z or an offset."""
    kind = F.col("event_type")
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    zulu = F.concat(F.date_format("ts", iso), F.lit("Z"))
    shifted = F.concat(F.date_format(F.col("ts") + F.expr("interval 2 hours"), iso), F.lit("+02:00"))

    def record(**fields):
        return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))

    text = (
        F.when(kind == "purchase", record(received_at=zulu))
        .when(kind == "error", record(created_at=shifted))
        .when(kind == "signup", record(created_at=zulu, received_at=shifted))
        .otherwise(record(created_at=zulu))
    )
    events = views.table(spark, d, "events").select("event_id", F.parse_json(text).alias("record"))
    return events.select(
        "event_id", incremental.record_time("record").cast("timestamp_ntz").alias("event_time")
    )


def incremental_filter(spark, d):
    events = views.event_stats(spark, d)
    return incremental.newer_than(events, "received_at", WATERMARK).select(
        "media_id", "visitor_key", "received_at"
    )


def full_load_topn(spark, d):
    events = views.table(spark, d, "events")
    newest = incremental.full_load(events, ["event_type"], "ts", ["event_id"])
    return newest.select("event_type", "event_id", "ts")


def full_load_one_feed(spark, d):
    events = views.table(spark, d, "events").withColumn("feed", F.lit("visitors"))
    return incremental.full_load(events, ["feed"], "ts", ["event_id"]).select("feed", "event_id", "ts")


def landing_latest(spark, d):
    uploads = views.table(spark, d, "events").select(
        F.get_json_object("props", "$.k").cast("bigint").alias("media_id"),
        F.col("ts").alias("uploaded_at"),
        "event_id",
        F.col("value").alias("payload"),
    )
    return incremental.landing_latest(uploads, ["media_id"], ["uploaded_at", "event_id"])


def _nested_orders(spark, d):
    return views.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.struct(
            F.col("o_custkey").alias("key"),
            F.struct(
                F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")
            ).alias("state"),
        ).alias("customer"),
        F.col("o_totalprice").alias("price"),
    )


def flatten_struct(spark, d):
    return flatten.flatten_structs(_nested_orders(spark, d), "_")


def incremental_flatten(spark, d):
    """Flatten, append to parquet in the shared folder, read it back."""
    path = scratch_path(spark, "incremental_flatten")
    jobs.append_flattened(_nested_orders(spark, d), path)
    return spark.read.parquet(path).withColumnsRenamed(
        {"customer.key": "customer_key", "customer.state.status": "status", "customer.state.priority": "priority"}
    )


def media_snapshot(spark, d):
    """Two days of snapshots; the second day runs twice and must not double."""
    path = scratch_path(spark, "media_snapshot")
    media = views.media_show(spark, d)
    jobs.snapshot_flattened(media, path, date(2024, 2, 1))
    jobs.snapshot_flattened(media, path, date(2024, 2, 2))
    jobs.snapshot_flattened(media, path, date(2024, 2, 2))
    return spark.read.parquet(path)


def incremental_pull_job(spark, d):
    """Two runs into the shared folder, the second over a grown source; what both landed."""
    landing, marks = scratch_path(spark, "landing"), scratch_path(spark, "marks")
    events = views.event_stats(spark, d).withColumn("received_at", F.col("received_at").cast("timestamp"))
    early = events.filter(F.col("received_at") <= F.lit(WATERMARK).cast("timestamp"))
    tie = ["media_id", "visitor_key", "percent_viewed"]
    first = jobs.incremental_pull(early, [], "received_at", tie, landing, marks, datetime(2024, 1, 16), cap=None)
    jobs.incremental_pull(events, [], "received_at", tie, landing, marks, datetime(2024, 1, 17))
    landed = spark.read.schema("media_id bigint, visitor_key bigint, received_at timestamp, run string").json(landing)
    return landed.select(
        "media_id", "visitor_key", F.col("received_at").cast("timestamp_ntz").alias("received_at"),
        F.when(F.col("run") == "20240116T000000", 1).otherwise(2).cast("bigint").alias("run"), F.lit(first).cast("bigint").alias("first"),
    )


#: Events of one landed file.
FILE_EVENTS = 64


def _landed_lists(spark, d):
    """Files of up to ``FILE_EVENTS`` events of a type: (kind, part, events, body), the body a JSON list."""
    events = views.table(spark, d, "events").select(
        F.col("event_type").alias("kind"), F.expr(f"event_id div {FILE_EVENTS}").alias("part"), "event_id", "ts",
        F.get_json_object("props", "$.k").alias("k"),
    )
    return events.withColumn("object", F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"k":'), "k", F.lit("}")))


def _list_of(column, order="event_id"):
    ordered = F.array_sort(F.collect_list(F.struct(order, column)))
    return F.concat(F.lit("["), F.array_join(F.transform(ordered, lambda e: e[column]), ","), F.lit("]"))


def convert_stream(spark, d):
    """Raw files appear in two steps; each step converts the new ones only."""
    zone = scratch_path(spark, "zone")
    for kind in ("view", "click"):
        lists = _landed_lists(spark, d).filter(F.col("kind") == kind).groupBy("part").agg(_list_of("object").alias("content"))
        path = F.concat(F.lit(f"{zone}/raw/{kind}/"), F.col("part").cast("string"), F.lit(".json"))
        files.write_files(lists.select(path.alias("path"), "content"))
        convert.convert_new_files(spark, f"{zone}/raw", f"{zone}/processed", f"{zone}/seen").awaitTermination()
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{zone}/processed")
    parsed = lines.select(F.from_json("value", "id bigint, k bigint").alias("r"))
    return parsed.select("r.id", "r.k")


def manifest_two_runs(spark, d):
    """What two incremental runs read. Before the second, a third of the files get the events of the
    second half too, a third are landed again as they were, and the rest stay; an empty file lies beside."""
    zone, state = scratch_path(spark, "zone"), scratch_path(spark, "state")
    events = _landed_lists(spark, d)
    early = events.filter(F.col("ts") <= F.lit(WATERMARK).cast("timestamp_ntz"))
    path = F.concat(F.lit(f"{zone}/raw/"), F.col("kind"), F.lit("/"), F.col("part").cast("string"), F.lit(".json"))
    lists = lambda df: df.groupBy("kind", "part").agg(_list_of("object").alias("content")).select(path.alias("path"), "content", "part")
    empty = events.select("kind").distinct().select(F.concat(F.lit(f"{zone}/raw/"), F.col("kind"), F.lit("/none.json")).alias("path"), F.lit("").alias("content"))
    files.write_files(lists(early).drop("part").unionByName(empty))
    manifest.pull(spark, [f"{zone}/raw"], state, "1")
    files.write_files(lists(events.filter(F.col("part") % 3 == 0)).drop("part"))
    files.write_files(lists(early.filter(F.col("part") % 3 == 1)).drop("part"))
    manifest.pull(spark, [f"{zone}/raw"], state, "2")
    name = F.regexp_extract("source_path", r"/raw/(.*)$", 1)
    read = manifest.documents(spark, state).select("run", name.alias("name"), "state", F.col("document").alias("text"))
    others = manifest.entries(spark, state).filter(F.col("state").isin("same", "gone"))
    name = F.regexp_extract("path", r"/raw/(.*)$", 1)
    return read.unionByName(others.select("run", name.alias("name"), "state", F.lit(None).cast("string").alias("text")))


def flatten_stream(spark, d):
    """An incremental table read twice: the second run sees the second half only."""
    zone = scratch_path(spark, "stream")
    orders = _nested_orders(spark, d)
    for step in (0, 1):
        orders.filter(F.col("id") % 2 == step).write.mode("append").parquet(f"{zone}/in")
        convert.flatten_new_files(spark, f"{zone}/in", orders.schema, f"{zone}/out", f"{zone}/seen", "parquet").awaitTermination()
    return spark.read.parquet(f"{zone}/out")


def flatten_if_struct(spark, d):
    """A snapshot whose input has structs, and one that is flat already."""
    path = scratch_path(spark, "snapshot")
    jobs.snapshot_flattened(_nested_orders(spark, d), path, date(2024, 2, 1))
    jobs.snapshot_flattened(flatten.flatten_structs(_nested_orders(spark, d)), path, date(2024, 2, 2))
    return spark.read.parquet(path).withColumnsRenamed(
        {"customer.key": "customer_key", "customer.state.status": "status", "customer.state.priority": "priority"}
    )


def star_tables(spark, d):
    """The whole star from the loading zone's tables, loaded twice; the rows of its three tables."""
    zone, out = scratch_path(spark, "loading"), scratch_path(spark, "star")
    sinks.append_parquet(views.event_stats(spark, d), f"{zone}/event_stats")
    sinks.append_parquet(views.visitor_stats(spark, d), f"{zone}/visitor_stats")
    sinks.truncate_load(views.media_show(spark, d), f"{zone}/media_show")
    sinks.truncate_load(views.visitor_stats(spark, d), f"{zone}/media_stats")
    for _ in range(2):
        jobs.build_star(spark, zone, out)
    counted = [
        spark.read.parquet(f"{out}/{name}").agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"))
        for name in ("dim_media", "dim_visitor", "fact_media_engagement")
    ]
    counted += [t.agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("rows")) for n, t in catalog.read_loading_zone(spark, zone).items()]
    return reduce(DataFrame.unionByName, counted)


def jsonl_files(spark, d):
    """Converted files that keep their names, and the lines they hold. A file has up to 64 events of a
    type; those of errors are broken, those of sign-ups empty lists, and every file of clicks is landed a
    second time in capitals, whose name is taken."""
    out = scratch_path(spark, "lines")
    events = _landed_lists(spark, d)
    item = F.when(F.col("kind") == "purchase", F.col("k")).otherwise(F.concat(F.expr("left(object, length(object) - 1)"), F.lit(',"n":null}')))
    lists = events.withColumn("item", item).groupBy("kind", "part").agg(_list_of("item").alias("text"))
    text = F.when(F.col("kind") == "error", F.substring("text", F.lit(1), F.length("text") - 1)).when(F.col("kind") == "signup", "[]").otherwise(F.col("text"))
    suffix = F.explode(F.when(F.col("kind") == "click", F.array(F.lit(".json"), F.lit(".JSON"))).otherwise(F.array(F.lit(".json"))))
    documents = lists.select("kind", "part", text.alias("document"), suffix.alias("suffix"))
    path = F.concat(F.lit("/zone/raw/"), "kind", F.lit("/"), F.col("part").cast("string"), "suffix")
    raw_json.write_line_files(documents.select(path.alias("source_path"), "document"), out)
    name = F.regexp_extract(F.input_file_name(), "/files/(.*)$", 1)
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{out}/files").select(name.alias("file"), "value")
    return lines.unionByName(spark.read.text(f"{out}/quarantine").select(F.lit("quarantine").alias("file"), "value"))


def _documents_with_lines(spark, d):
    return views.table(spark, d, "documents").select(
        "doc_id",
        F.struct("lang", "source").alias("meta"),
        F.split("text", "\n").alias("lines"),
    )


def flatten_array_child(spark, d):
    tables = flatten.relationalize(_documents_with_lines(spark, d), ["doc_id"])
    return (
        tables["root.lines"]
        .join(tables["root"], "doc_id")
        .select(
            "doc_id",
            F.col("`meta.lang`").alias("lang"),
            F.col("index").cast("bigint").alias("index"),
            F.md5("value").alias("line_md5"),
        )
    )


QUERIES = {
    "raw_json_records": raw_json_records,
    "raw_to_jsonl": raw_to_jsonl,
    "backfill_quarantine": backfill_quarantine,
    "run_metrics": run_metrics,
    "event_time_normalize": event_time_normalize,
    "incremental_filter": incremental_filter,
    "full_load_topn": full_load_topn,
    "full_load_one_feed": full_load_one_feed,
    "landing_latest": landing_latest,
    "flatten_struct": flatten_struct,
    "incremental_flatten": incremental_flatten,
    "media_snapshot": media_snapshot,
    "flatten_array_child": flatten_array_child,
    "incremental_pull_job": incremental_pull_job,
    "convert_stream": convert_stream,
    "flatten_stream": flatten_stream,
    "flatten_if_struct": flatten_if_struct,
    "star_tables": star_tables,
    "jsonl_files": jsonl_files,
    "manifest_two_runs": manifest_two_runs,
}

_DOCS = """docs AS (
  SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         '/zone/raw/' || event_type || '/' || event_id || '.part.json' AS source_path
  FROM events)"""

_LOG = f"""{_DOCS}, log AS (
  SELECT source_path, event_type AS feed,
         CASE WHEN event_type = 'error' THEN 'quarantined' ELSE 'converted' END AS status,
         CAST(CASE event_type WHEN 'view' THEN 5 WHEN 'error' THEN 0 WHEN 'signup' THEN 0 ELSE 1 END
              AS BIGINT) AS records
  FROM docs)"""

_NESTED_FLAT = """SELECT o_orderkey AS id, o_custkey AS customer_key, o_orderstatus AS {0},
       o_orderpriority AS {1}, o_totalprice AS price FROM orders"""

SQL = {
    "raw_json_records": f"""WITH {_DOCS}
SELECT source_path, CAST(n AS BIGINT) AS record_no,
       CASE WHEN event_type IN ('view', 'click') AND n < 2 THEN event_id END AS id, CASE WHEN n < 2 THEN k END AS k,
       CASE n WHEN 2 THEN '12' WHEN 3 THEN 'abc' END AS text, n = 4 AS nothing
FROM docs, range(5) r(n)
WHERE event_type = 'view' OR (n = 0 AND event_type IN ('click', 'purchase'))""",
    "raw_to_jsonl": f"""WITH {_DOCS}
SELECT source_path, '/zone/processed/' || event_type || '/' || event_id || '.part.jsonl' AS target_path,
       CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR)
            WHEN n >= 2 THEN ['"12"', '"abc"', 'null'][n - 1]
            WHEN event_type = 'view' AND n = 0 THEN '{{"id":' || event_id || ',"k":' || k || ',"n":null}}'
            ELSE '{{"id":' || event_id || ',"k":' || k || '}}' END AS line
FROM docs, range(5) r(n)
WHERE event_type = 'view' OR (n = 0 AND event_type IN ('click', 'purchase'))""",
    "backfill_quarantine": f"WITH {_LOG} SELECT source_path, status, records FROM log",
    "run_metrics": f"""WITH {_LOG}
SELECT feed, status, count(*) AS files, CAST(sum(records) AS BIGINT) AS records FROM log GROUP BY feed, status""",
    "event_time_normalize": "SELECT event_id, ts AS event_time FROM events",
    "incremental_filter": f"""WITH {EVENT_STATS}
SELECT media_id, visitor_key, received_at FROM event_stats WHERE received_at > TIMESTAMP '{WATERMARK}'""",
    "full_load_topn": """SELECT event_type, event_id, ts FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) <= 5000""",
    "full_load_one_feed": """SELECT 'visitors' AS feed, event_id, ts FROM events
ORDER BY ts DESC, event_id LIMIT 5000""",
    "landing_latest": """SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS media_id, ts AS uploaded_at,
       event_id, value AS payload FROM events
QUALIFY row_number() OVER (PARTITION BY media_id ORDER BY ts DESC, event_id DESC) = 1""",
    "flatten_struct": _NESTED_FLAT.format("customer_state_status", "customer_state_priority"),
    "incremental_flatten": _NESTED_FLAT.format("status", "priority"),
    "media_snapshot": f"""WITH {MEDIA_SHOW}
SELECT *, DATE '2024-02-01' AS snapshot_date FROM media_show
UNION ALL SELECT *, DATE '2024-02-02' AS snapshot_date FROM media_show""",
    "flatten_array_child": """SELECT doc_id, lang, CAST(i - 1 AS BIGINT) AS index, md5(line) AS line_md5
FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)""",
    "incremental_pull_job": f"""WITH {EVENT_STATS}
SELECT media_id, visitor_key, received_at, CAST(CASE WHEN received_at <= TIMESTAMP '{WATERMARK}' THEN 1 ELSE 2 END AS BIGINT) AS run,
       (SELECT count(*) FROM event_stats WHERE received_at <= TIMESTAMP '{WATERMARK}') AS first FROM event_stats""",
    "convert_stream": """SELECT event_id AS id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events WHERE event_type IN ('view', 'click')""",
    "flatten_stream": _NESTED_FLAT.format("customer_state_status", "customer_state_priority"),
    "flatten_if_struct": f"""{_NESTED_FLAT.format("status", "priority").replace(" FROM", ", DATE '2024-02-01' AS snapshot_date FROM")}
UNION ALL {_NESTED_FLAT.format("status", "priority").replace(" FROM", ", DATE '2024-02-02' AS snapshot_date FROM")}""",
    "star_tables": f"""SELECT 'dim_media' AS name, count(*) AS rows FROM (SELECT DISTINCT * EXCLUDE (channel) FROM ({STAR_SQL["dim_media"]}))
UNION ALL SELECT 'dim_visitor', count(*) FROM ({STAR_SQL["dim_visitor"]})
UNION ALL SELECT 'fact_media_engagement', count(*) FROM ({STAR_SQL["fact_media_engagement"]})
UNION ALL SELECT 'event_stats', count(*) FROM events
UNION ALL SELECT 'visitor_stats', count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'media_stats', count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'media_show', count(*) FROM part""",
    "jsonl_files": """WITH e AS (
  SELECT event_type AS kind, event_id // 64 AS part, event_id, json_extract_string(props, '$.k') AS k FROM events),
f AS (SELECT DISTINCT kind, part FROM e)
SELECT 'zone/processed/' || kind || '/' || part || '.jsonl' AS file,
       CASE WHEN kind = 'purchase' THEN k ELSE '{"id":' || event_id || ',"k":' || k || ',"n":null}' END AS value
FROM e WHERE kind IN ('view', 'click', 'purchase')
UNION ALL SELECT 'quarantine', '{"source_path":"/zone/raw/error/' || part || '.json","reason":"not a JSON document"}' FROM f WHERE kind = 'error'
UNION ALL SELECT 'quarantine', '{"source_path":"/zone/raw/click/' || part || '.json","reason":"name is taken"}' FROM f WHERE kind = 'click'""",
    "manifest_two_runs": f"""WITH e AS (
  SELECT event_type AS kind, event_id // 64 AS part, event_id, ts <= TIMESTAMP '{WATERMARK}' AS early,
         '{{"id":' || event_id || ',"k":' || json_extract_string(props, '$.k') || '}}' AS object FROM events),
f AS (
  SELECT kind, part, '[' || string_agg(object, ',' ORDER BY event_id) || ']' AS whole,
         '[' || string_agg(object, ',' ORDER BY event_id) FILTER (WHERE early) || ']' AS first FROM e GROUP BY kind, part)
SELECT '1' AS run, kind || '/' || part || '.json' AS name, 'new' AS state, first AS text FROM f WHERE first IS NOT NULL
UNION ALL SELECT DISTINCT '1', kind || '/none.json', 'new', '' FROM e
UNION ALL SELECT '2', kind || '/' || part || '.json', CASE WHEN first IS NULL THEN 'new' WHEN first <> whole THEN 'changed' ELSE 'same' END,
       CASE WHEN first IS NULL OR first <> whole THEN whole END FROM f WHERE part % 3 = 0
UNION ALL SELECT '2', kind || '/' || part || '.json', 'same', NULL FROM f WHERE part % 3 = 1 AND first IS NOT NULL""",
}
