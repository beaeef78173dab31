"""Small tables with every odd case, and plain rewrites of the operators' rules."""

from __future__ import annotations

import duckdb

#: Columns with names that operators use inside.
CLASHING = "key string, node long, start long, mark long, spans string, runs string, known string, score double, class long, term string, part int, rank long, held_out string, item string"

ODD = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, "   \n\t ", "fr"),
    (5, "the quick brown fox jumps over the lazy dog again and again", "en"),
    (5, "the quick brown fox jumps over the lazy dog again and again", "en"),
    (6, "é", None),
    (None, "a row without an id", "en"),
    (None, None, None),
    (7, "x" * 50_000, "de"),
    (8, " ".join(f"w{i}" for i in range(30_000)), "en"),
    (9, "中文 字 123 456 !!", None),
]


def table(spark, rows, clashing=True):
    """Documents from (doc_id, text, lang) rows, with clashing extra columns."""
    df = spark.createDataFrame([(i, t, x, "s", len(t or "")) for i, t, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    if clashing:
        for field in CLASHING.split(", "):
            name, kind = field.split()
            df = df.selectExpr("*", f"CAST(NULL AS {kind}) AS `{name}`")
    return df


def texts(folder):
    """All (doc_id, text) of a supplied table in id order; null as empty."""
    return duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
