"""Text-corpus queries over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewloom.functions import texts
from viewloom.operators import encoding, language
from viewloom.plans import views


def _documents(spark, d, *columns):
    return views.spread(views.table(spark, d, "documents").select(*columns))


def content_fingerprint(spark, d):
    return language.copy_groups(_documents(spark, d, "doc_id", "text"), "doc_id", "text")


def script_profile(spark, d):
    profile = language.script_profile(_documents(spark, d, "doc_id", "text"), ["doc_id"], "text")
    return profile.select("doc_id", F.array_join("blocks", ",").alias("blocks"))


def text_noise(spark, d):
    return texts.noise_score(
        texts.noise_parts(_documents(spark, d, "doc_id", "text"), "text"), "text"
    ).drop("text")


def text_noise_counts(spark, d):
    """The count-based parts, whole texts."""
    parts = texts.noise_parts(_documents(spark, d, "doc_id", "text"), "text")
    return parts.select(
        "doc_id",
        *[F.round(c, 6).alias(c) for c in ("marks", "accents", "unreadable", "double_accents", "case_flips")],
    )


def _letter_table(spark, d):
    return language.learn_letters(_documents(spark, d, "text", "lang"), "text", "lang")


def language_letters(spark, d):
    return _letter_table(spark, d).select("language", F.array_join("letters", "").alias("letters"))


def language_rank(spark, d):
    docs = _documents(spark, d, "doc_id", "text")
    scores = language.language_scores(docs, "text", _letter_table(spark, d), ["doc_id"])
    return language.best_language(scores, ["doc_id"])


def language_rank_all(spark, d):
    docs = _documents(spark, d, "doc_id", "text")
    return language.language_scores(docs, "text", _letter_table(spark, d), ["doc_id"])


def language_merge(spark, d):
    """Halves of documents as chunks, with a second, plainly sorted alphabet per language as its
    alternative; the chunks' scores merged per document."""
    table = _letter_table(spark, d)
    other = table.select(F.concat("language", F.lit("—")).alias("language"), F.array_sort("letters").alias("letters"))
    half = F.floor(F.length("text") / 2).cast("int")
    chunks = F.array(F.substring("text", F.lit(1), half), F.substr(F.col("text"), half + 1))
    docs = _documents(spark, d, "doc_id", "text").select("doc_id", F.posexplode(chunks).alias("chunk", "text"))
    scores = language.language_scores(docs, "text", table.unionByName(other), ["doc_id", "chunk"])
    return language.merge_scores(scores, ["doc_id"])


def _files(spark, d):
    """Documents as bytes: plain, marked, UTF-16 or Latin-1 by language, with a
    declaration in front of some."""
    text, lang = F.col("text"), F.col("lang")
    latin = F.encode(F.regexp_replace(text, r"[^\x00-\xFF]+", "?"), "ISO-8859-1")
    declared = F.concat(F.lit("<?xml encoding='UTF-8'?>\n"), text)
    content = (
        F.when(lang == "fr", latin)
        .when(lang == "de", F.concat(F.unhex(F.lit("EFBBBF")), F.encode(text, "UTF-8")))
        .when(lang == "es", F.encode(text, "UTF-16"))
        .when(F.length(text) > 2000, F.encode(declared, "UTF-8"))
        .otherwise(F.encode(text, "UTF-8"))
    )
    return _documents(spark, d, "doc_id", "lang", "text").select("doc_id", content.alias("content"))


def encoding_marks(spark, d):
    return encoding.encoding_marks(_files(spark, d)).drop("content")


def encoding_audit(spark, d):
    table = _letter_table(spark, d)
    return encoding.encoding_audit(_files(spark, d), ["doc_id"], languages=table)


QUERIES = {
    "content_fingerprint": content_fingerprint,
    "script_profile": script_profile,
    "text_noise": text_noise,
    "text_noise_counts": text_noise_counts,
    "language_letters": language_letters,
    "language_rank": language_rank,
    "language_rank_all": language_rank_all,
    "language_merge": language_merge,
    "encoding_marks": encoding_marks,
    "encoding_audit": encoding_audit,
}

# The documents are written in Latin letters, so each text is one layer.
_RANK_OF = r"""WITH c AS (
  SELECT lang, unnest(string_split(lower(text), '')) AS ch FROM documents),
n AS (SELECT lang, ch, count(*) AS n FROM c WHERE regexp_matches(ch, '[\p{{L}}]') GROUP BY lang, ch
  QUALIFY count(*) >= 0.0005 * sum(count(*)) OVER (PARTITION BY lang)),
one AS (
  SELECT lang AS language, ch, row_number() OVER (PARTITION BY lang ORDER BY n DESC, ch) - 1 AS there,
         count(*) OVER (PARTITION BY lang) AS size,
         bool_or(regexp_matches(ch, '[àáâãäåèéêëìíîïñòóôõöùúûüýÿç]')) OVER (PARTITION BY lang) AS has_accent FROM n),
t AS (FROM one{alternative}),
d AS (
  SELECT doc_id, ch, count(*) AS n, min(place) AS place FROM (
    SELECT doc_id, unnest(string_split(lower(text), '')) AS ch, generate_subscripts(string_split(lower(text), ''), 1) AS place
    FROM {source}) WHERE regexp_matches(ch, '[\p{{L}}]') GROUP BY doc_id, ch),
f AS (
  SELECT doc_id, ch, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, place) - 1 AS rank,
         count(*) OVER (PARTITION BY doc_id) AS found,
         bool_or(regexp_matches(ch, '[àáâãäåèéêëìíîïñòóôõöùúûüýÿç]')) OVER (PARTITION BY doc_id) AS accented
  FROM d QUALIFY sum(n) OVER (PARTITION BY doc_id) > 32),
p AS (SELECT doc_id, language, rank, found, there, size FROM f JOIN t USING (ch) WHERE has_accent OR NOT accented),
q AS (
  SELECT a.doc_id, a.language, a.rank, a.there, any_value(a.found) AS found, any_value(a.size) AS size,
         count(*) FILTER (WHERE b.rank < a.rank AND b.there < a.there) AS before,
         count(*) FILTER (WHERE b.rank >= a.rank AND b.there >= a.there) AS after
  FROM p a JOIN p b ON a.doc_id = b.doc_id AND a.language = b.language GROUP BY a.doc_id, a.language, a.rank, a.there),
k AS (
  SELECT *, abs(floor(rank * CAST(size AS DOUBLE) / found) - there) AS apart,
         there = 0 OR before >= 0.4 * there OR after >= 0.4 * (size - there) AS company FROM q),
scores AS (
  SELECT doc_id, language, round(count(*) FILTER (WHERE CASE WHEN size <= 26 THEN apart <= 4 AND company ELSE apart < size / 3 OR company END)
         / any_value(found), 4) AS score
  FROM k GROUP BY doc_id, language HAVING count(*) >= 0.2 * any_value(size)
     AND count(*) FILTER (WHERE CASE WHEN size <= 26 THEN apart <= 4 AND company ELSE apart < size / 3 OR company END) / any_value(found) >= 0.1)
"""

_RANK = _RANK_OF.format(source="documents", alternative="")
_CHUNKS = """(SELECT doc_id * 2 AS doc_id, substr(text, 1, length(text) // 2) AS text FROM documents
          UNION ALL SELECT doc_id * 2 + 1, substr(text, length(text) // 2 + 1) FROM documents)"""
_ALTERNATIVE = """
  UNION ALL SELECT language || '—', ch, row_number() OVER (PARTITION BY language ORDER BY ch) - 1, size, has_accent FROM one"""

SQL = {
    "content_fingerprint": """SELECT sha256(text) AS fingerprint, count(*) AS copies, min(doc_id) AS first_key
FROM documents GROUP BY 1""",
    "script_profile": r"""WITH c AS (
  SELECT DISTINCT doc_id, unicode(ch) AS u FROM (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> ''),
b AS (
  SELECT DISTINCT doc_id, CASE WHEN u < 32 THEN 'Control character' WHEN u < 128 THEN 'Basic Latin'
    WHEN u < 256 THEN 'Latin-1 Supplement' WHEN u < 384 THEN 'Latin Extended-A'
    WHEN u BETWEEN 8192 AND 8303 THEN 'General Punctuation' ELSE 'other' END AS block FROM c)
SELECT doc_id, string_agg(block, ',' ORDER BY block) AS blocks FROM b GROUP BY doc_id""",
    "text_noise_counts": r"""WITH c AS (
  SELECT doc_id, i, ch, unicode(ch) AS u FROM (
    SELECT doc_id, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) AS i FROM documents)
  WHERE ch <> ''),
k AS (
  SELECT *, u >= 32 AND u <> 127 AND NOT (u BETWEEN 128 AND 160) AND u <> 173 AS shown,
         regexp_matches(ch, '[\p{L}]') AS letter,
         ch IN ('!','#','%','''','*','.','?','@','\','_','¡','§','«','¶','·','»','¿') OR u BETWEEN 8192 AND 8303 AS punct,
         ch IN ('$','+','^','`','~','¢','£','¤','¥','¦','¨','©','¬','®','¯','°','±','´','¸','×','÷','¼','½','¾','€') AS symbol,
         regexp_matches(ch, '[àáâãäåèéêëìíîïñòóôõöùúûüýÿçÀÁÂÃÄÅÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝÇ]') AS accent,
         translate(ch, 'àáâãäåèéêëìíîïñòóôõöùúûüýÿçÀÁÂÃÄÅÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝÇ',
                       'aaaaaaeeeeiiiinooooouuuuyycAAAAAAEEEEIIIINOOOOOUUUUYC') AS bare,
         regexp_matches(ch, '[\p{Lu}]') AS upper
  FROM c),
s AS (SELECT doc_id, punct, symbol, ch IS DISTINCT FROM lag(ch) OVER (PARTITION BY doc_id ORDER BY i) AS fresh FROM k WHERE shown),
m AS (
  SELECT doc_id, (count(*) FILTER (WHERE punct AND fresh) + 2 * count(*) FILTER (WHERE symbol AND fresh)) / count(*) AS marks
  FROM s GROUP BY doc_id),
l AS (
  SELECT doc_id, accent AND lag(accent) OVER w AS pair, bare = lag(bare) OVER w AS same, upper AND lag(upper) OVER w AS caps
  FROM k WHERE letter AND ch NOT IN ('ª', 'º') WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
t AS (
  SELECT doc_id, 2 * (count(*) FILTER (WHERE pair AND same) + count(*) FILTER (WHERE pair AND caps)) / count(*) AS twice
  FROM l GROUP BY doc_id),
a AS (
  SELECT doc_id, count(*) FILTER (WHERE letter) AS n, count(*) FILTER (WHERE accent) / nullif(count(*) FILTER (WHERE letter), 0) AS share,
         8 * count(*) FILTER (WHERE u < 9 OR u BETWEEN 14 AND 25 OR u = 27 OR u = 127 OR (u BETWEEN 128 AND 159 AND u <> 133) OR u = 173)
           / (count(*) + 1) AS unreadable FROM k GROUP BY doc_id),
g AS (
  SELECT *, letter AND (upper OR regexp_matches(ch, '[\p{Ll}]')) AS cased FROM k),
r AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, cased ORDER BY i) AS run FROM g),
x AS (
  SELECT *, cased AND upper <> lag(upper) OVER (PARTITION BY doc_id, cased, run ORDER BY i) AS flip FROM r),
y AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY i) - row_number() OVER (PARTITION BY doc_id, run, flip ORDER BY i) AS chain
  FROM x WHERE cased),
z AS (SELECT doc_id, run, max(i) AS last, bool_or(u > 127) AS foreign_, count(*) AS n FROM y GROUP BY doc_id, run),
f AS (SELECT doc_id, run, count(*) // 2 * 2 AS n FROM y WHERE flip GROUP BY doc_id, run, chain),
v AS (
  SELECT f.doc_id, sum(f.n) AS flips FROM f JOIN z ON z.doc_id = f.doc_id AND z.run = f.run
  LEFT JOIN k ON k.doc_id = f.doc_id AND k.i = z.last + 1
  WHERE z.foreign_ AND z.n BETWEEN 3 AND 64 AND NOT coalesce(regexp_matches(k.ch, '[\p{Nd}]'), false) GROUP BY f.doc_id)
SELECT d.doc_id, round(CASE WHEN m.marks >= 0.3 THEN m.marks ELSE 0 END, 6) AS marks,
       round(CASE WHEN a.n >= 8 AND a.share >= 0.35 THEN a.share ELSE 0 END, 6) AS accents,
       round(coalesce(a.unreadable, 0), 6) AS unreadable, round(coalesce(t.twice, 0), 6) AS double_accents,
       round(coalesce(v.flips, 0) / (length(d.text) + 1), 6) AS case_flips
FROM documents d LEFT JOIN m ON m.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
LEFT JOIN a ON a.doc_id = d.doc_id LEFT JOIN v ON v.doc_id = d.doc_id""",
    "language_letters": r"""WITH c AS (
  SELECT lang, unnest(string_split(lower(text), '')) AS ch FROM documents),
n AS (SELECT lang, ch, count(*) AS n FROM c WHERE regexp_matches(ch, '[\p{L}]') GROUP BY lang, ch
  QUALIFY count(*) >= 0.0005 * sum(count(*)) OVER (PARTITION BY lang))
SELECT lang AS language, string_agg(ch, '' ORDER BY n DESC, ch) AS letters FROM n GROUP BY lang""",
    "language_rank_all": _RANK + "SELECT doc_id, language, score FROM scores",
    "language_rank": _RANK + "SELECT doc_id, language, score FROM scores\nQUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, language DESC) = 1",
    "language_merge": _RANK_OF.format(source=_CHUNKS, alternative=_ALTERNATIVE) + """, whole AS (
  SELECT doc_id // 2 AS doc_id, language,
         (2 * sum(CAST(round(score * 10000) AS BIGINT)) + count(*)) // (2 * count(*)) / 10000 AS score FROM scores GROUP BY 1, 2)
SELECT doc_id, replace(language, '—', '') AS language, max(score) AS score FROM whole GROUP BY 1, 2""",
    "encoding_marks": r"""WITH f AS (
  SELECT doc_id, lang, text, regexp_matches(text, '[^\x00-\x7F]') AS wide, regexp_matches(text, '[\x{80}-\x{FF}]') AS latin FROM documents)
SELECT doc_id, CASE lang WHEN 'de' THEN 'utf_8' WHEN 'es' THEN 'utf_16' END AS bom,
       CASE WHEN lang = 'en' AND length(text) > 2000 THEN 'utf_8' END AS declared,
       CASE lang WHEN 'de' THEN false WHEN 'es' THEN false WHEN 'fr' THEN NOT latin ELSE NOT wide END AS ascii,
       CASE lang WHEN 'es' THEN false WHEN 'fr' THEN NOT latin ELSE true END AS utf8 FROM f""",
}
