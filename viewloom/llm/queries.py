"""One query per operator over the whole ``documents`` table, and SQL twins where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm import bin_sketch, disclosure, hyper_lang, latent_votes, order_minhash, pattern_pack, periodic_runs, phrase_index, prefix_counts, rans_files, secret_layers, super_windows, term_tree


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/benchmark.parquet")


def op1_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.near_duplicates(documents(spark, folder)).withColumnRenamed("class", "class_id")


def op2_secret_layers(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_layers.find_secrets(documents(spark, folder))
    return found.select(
        "doc_id",
        *[secret_layers.count_kind("base", kind).alias(f"n_{kind}") for kind in secret_layers.KINDS],
        F.sha2(secret_layers.joined_spans("base"), 256).alias("base_sha256"),
        secret_layers.joined_spans("spans").alias("spans"),
    )


def op3_disclosure(spark: SparkSession, folder: str) -> DataFrame:
    found = disclosure.find_personal(documents(spark, folder))
    return found.select(
        "doc_id",
        *[disclosure.count_kind("base", kind).alias(f"n_{kind}") for kind in disclosure.KINDS],
        F.sha2(disclosure.joined_spans("base"), 256).alias("base_sha256"),
        disclosure.joined_spans("spans").alias("spans"),
    )


def op4_bin_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return bin_sketch.fingerprints(documents(spark, folder)).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        bin_sketch.packed(F.col("bits")).alias("fingerprint"),
        bin_sketch.packed(F.col("edited_bits")).alias("edited_fingerprint"),
        bin_sketch.likeness(F.col("bits"), F.col("edited_bits")).alias("near_edited"),
        bin_sketch.likeness(F.col("bits"), F.col("next_bits")).alias("near_next"),
    )


def op5_prefix_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = prefix_counts.prefix_counts(documents(spark, folder), budget=4096)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"), "fits_chars")


def op6_hyper_lang(spark: SparkSession, folder: str) -> DataFrame:
    return hyper_lang.identify(documents(spark, folder)).drop("text")


def op7_phrase_index(spark: SparkSession, folder: str) -> DataFrame:
    found = phrase_index.find_passages(documents(spark, folder), benchmark(spark, folder))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS s FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS words
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s
        FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
hit AS (SELECT doc_id, s, dw.k, item_id FROM dw JOIN win USING (k, words)),
covered AS (SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(s, s + k - 1)) AS place FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return rans_files.token_files(documents(spark, folder))


def op9_pattern_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pattern_pack.pack(documents(spark, folder))


def op10_super_windows(spark: SparkSession, folder: str) -> DataFrame:
    kept = super_windows.remove_repeats(documents(spark, folder))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS words
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS s FROM d WHERE len(w) >= 20)),
again AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY words ORDER BY doc_id, s) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + 19)) AS place FROM again),
word AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS place FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op11_term_tree(spark: SparkSession, folder: str) -> DataFrame:
    return term_tree.audit(documents(spark, folder))


OP11_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w,
         row_number() OVER () AS doc FROM documents),
word AS (SELECT lang, source, doc, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM word GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
lang_total AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
have AS (SELECT lang, source, term, count(*) AS n FROM word SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
total AS (SELECT lang, source, sum(n) AS total FROM have GROUP BY lang, source),
grp AS (SELECT DISTINCT lang, source FROM d),
p AS (
  SELECT lang, source, term, coalesce(have.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(have.n, 0) + 2)) // (coalesce(total.total, 0) + 2 * v) AS p,
         1 + (1000000000::HUGEINT * (kept.n + 2)) // (lang_total.total + 2 * v) AS q
  FROM grp JOIN kept USING (lang) JOIN lang_total USING (lang)
  LEFT JOIN total USING (lang, source) LEFT JOIN have USING (lang, source, term)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM every QUALIFY part = 'pair' OR rank <= 10
"""


def op12_latent_votes(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return latent_votes.score_quality(documents(spark, folder), labels)


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, chosen by id, repeat a stretch of their words to the end of the text."""
    chosen = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(F.col("chosen") % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), 1))
    docs = docs.select("doc_id", "text", chosen.alias("chosen")).withColumn("words", words)
    g, n = F.floor(F.col("chosen") / 10), F.size("words").cast("long")
    docs = docs.select("doc_id", "text", "words", F.when(n > 0, F.struct(n.alias("n"), (g % n).alias("a"), (g % 8 + 3).alias("parts"))).alias("cut"))
    a, p = F.col("cut.a"), 1 + F.floor((F.col("cut.n") - F.col("cut.a")) / F.col("cut.parts"))
    places = F.transform(F.sequence(F.lit(0), F.col("cut.n") - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))
    planted = F.array_join(F.transform(places, lambda i: F.get("words", i)), " ")
    return docs.select("doc_id", F.when(F.col("cut").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_with_planted_runs(documents(spark, folder)))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("longest", longest)
    length = -F.col("longest.less")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        length.alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(1000 * length / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_order_minhash": op1_order_minhash,
    "op2_secret_layers": op2_secret_layers,
    "op3_disclosure": op3_disclosure,
    "op4_bin_sketch": op4_bin_sketch,
    "op5_prefix_counts": op5_prefix_counts,
    "op6_hyper_lang": op6_hyper_lang,
    "op7_phrase_index": op7_phrase_index,
    "op8_token_files": op8_token_files,
    "op9_pattern_packing": op9_pattern_packing,
    "op10_super_windows": op10_super_windows,
    "op11_term_tree": op11_term_tree,
    "op12_latent_votes": op12_latent_votes,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL: dict[str, str] = {
    "op7_phrase_index": OP7_SQL,
    "op10_super_windows": OP10_SQL,
    "op11_term_tree": OP11_SQL,
}
