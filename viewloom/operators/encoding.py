"""Character encodings of a file corpus."""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from encodings.aliases import aliases
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.functions.binding import let
from viewloom.functions.texts import noise_score
from viewloom.operators.codepages import basic_ideographs, likely_readings
from viewloom.operators.language import best_language, language_scores, letter_counts
from viewloom.session import scratch_path

# Byte order marks, longest first, in hex.
MARKS = {
    "0000FEFF": "utf_32",
    "FFFE0000": "utf_32",
    "84319533": "gb18030",
    "2B2F7638": "utf_7",
    "2B2F7639": "utf_7",
    "2B2F762B": "utf_7",
    "2B2F762F": "utf_7",
    "EFBBBF": "utf_8",
    "FEFF": "utf_16",
    "FFFE": "utf_16",
}
# A declaration counts in the head of a file only, as in markup standards.
DECLARATION_ZONE = 8192
# Where a file may name its charset: the XML declaration, an HTML meta element, the first rule of a
# style sheet, a MIME parameter, and the coding comment in the first two lines of a source file.
_NAME = r"([A-Za-z0-9][A-Za-z0-9._:\-]*)"
DECLARATIONS = [
    rf"""^\s*<\?xml\s[^>]*?\bencoding\s*=\s*["']{_NAME}["']""",
    rf"""(?i)<meta\s[^>]*?\bcharset\s*=\s*["']?\s*{_NAME}""",
    rf"""^@charset\s+"{_NAME}";""",
    rf"""(?i);\s*charset\s*=\s*"?{_NAME}""",
    rf"""^(?:[^\n]*\n)?[ \t\f]*(?:#|//|/\*|--|%|;|")[^\n]*?coding[:=][ \t]*{_NAME}""",
]
NOISE_LIMIT = 0.2

# Code pages in order of preference, before all others.
CODE_PAGES = [
    "cp1252", "cp1250", "cp1251", "cp1253", "cp1255", "cp1256", "cp1257", "koi8_r", "iso8859_5",
    "cp437", "cp850", "mac_roman", "gb18030", "big5", "shift_jis", "euc_jp", "euc_kr",
]


#: Codecs that rewrite text instead of reading a charset.
_NO_CHARSETS = {"idna", "mbcs", "oem", "punycode", "raw_unicode_escape", "undefined", "unicode_escape"}


@lru_cache
def text_codecs() -> tuple[str, ...]:
    """Every charset the Python library can read, the preferred code pages first. Only
    these names are taken from a file's own declaration."""
    found = []
    for name in sorted(set(aliases.values()) - _NO_CHARSETS):
        try:
            "a".encode(name)
            found.append(name)
        except (LookupError, UnicodeError):
            continue
    return (*CODE_PAGES, *[n for n in found if n not in CODE_PAGES])


def known_charset(name: str | None) -> str | None:
    """The library's name of a declared charset, or ``None`` if it reads no text."""
    try:
        plain = codecs.lookup(name).name.replace("-", "_") if name else ""
    except LookupError:
        return None
    plain = aliases.get(plain, plain)
    return plain if plain in text_codecs() else None


def read_corpus(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files below a path as (path, content)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return files.option("pathGlobFilter", glob).load(path).select("path", "content")


def byte_order_mark(content: Column) -> Column:
    head = F.hex(F.substring(content, 1, 4))
    found = None
    for mark, name in MARKS.items():
        hit = F.startswith(head, F.lit(mark))
        found = F.when(hit, name) if found is None else found.when(hit, name)
    return found


def declared_charset(content: Column) -> Column:
    """A charset named in the head of the file, lower case with underscores."""
    head = F.decode(F.substring(content, 1, DECLARATION_ZONE), "ISO-8859-1")
    plain = F.regexp_replace(head, r"[^\x00-\x7F]+", "")

    def named(head: Column) -> Column:
        names = [F.get(F.regexp_extract_all(head, F.lit(pattern), 1), F.lit(0)) for pattern in DECLARATIONS]
        return F.lower(F.replace(F.coalesce(*names), F.lit("-"), F.lit("_")))

    # All of them have one of two words.
    return F.when(plain.rlike("[Cc](?i:harset|oding)"), let(plain, named))


def is_ascii(content: Column) -> Column:
    """No byte above 127. In UTF-8 text that is one byte per character."""
    text = content.cast("string")
    return F.is_valid_utf8(text) & (F.octet_length(content) == F.length(F.try_validate_utf8(text)))


def encoding_marks(files: DataFrame, content: str = "content") -> DataFrame:
    """Add what the bytes say by themselves: mark, declaration, ASCII, valid UTF-8."""
    c = F.col(content)
    return files.withColumns(
        {
            "bom": byte_order_mark(c),
            "declared": declared_charset(c),
            "ascii": is_ascii(c),
            "utf8": F.is_valid_utf8(c.cast("string")),
        }
    )


def _decoder(names: list[str]):
    @F.pandas_udf("array<struct<charset:string,text:string>>")
    def decode(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        def tried(content, mark, declared):
            data, found = bytes(content), {}  # text: the first charset in the order of trust that reads it so
            mark, declared = known_charset(mark), known_charset(declared)
            for name in filter(None, (mark, declared)):
                try:
                    found.setdefault(data.decode(name), name)
                except (UnicodeDecodeError, LookupError, ValueError):
                    continue
                if name == mark:  # a mark that the bytes bear out settles it
                    break
            if mark not in found.values():
                for name, text in likely_readings(data, tuple(names)):
                    found.setdefault(text, name)
            return [{"charset": name, "text": text} for text, name in found.items()]

        for contents, marks, names_ in batches:
            yield pd.Series([None if c is None else tried(c, m, n) for c, m, n in zip(contents, marks, names_)])

    return decode


def candidates(files: DataFrame, content: str, code_pages: list[str]) -> DataFrame:
    """One row per file with its readings: charset and text, in the order of trust.
    ASCII and UTF-8 files are decoded by the JVM; only the others, marked ones too, go
    through their wished charset and the code pages, of which those stay that can read
    the bytes and look about least odd by them. A mark that fits is the only reading,
    and equal readings count once."""
    marked = encoding_marks(files, content)
    c = F.col(content)
    body = F.when(F.col("bom") == "utf_8", F.substr(c, F.lit(4))).otherwise(c)
    needs_pages = ~F.col("utf8")
    pages = _decoder(code_pages)(F.when(needs_pages, c), F.when(needs_pages, F.col("bom")), F.when(needs_pages, F.col("declared")))
    direct = F.struct(
        F.when(F.col("ascii"), "ascii").otherwise("utf_8").alias("charset"),
        F.try_validate_utf8(body.cast("string")).alias("text"),
    )
    none = F.array().cast("array<struct<charset:string,text:string>>")
    every = F.when(needs_pages, pages).when(F.col("utf8"), F.array(direct)).otherwise(none)
    return marked.withColumn("_all", every)


def encoding_audit(
    files: DataFrame,
    key: list[str],
    content: str = "content",
    code_pages: list[str] | None = None,
    languages: DataFrame | None = None,
) -> DataFrame:
    """One row per file: mark, declaration, chosen encoding, its noise and (with a
    letter table) language, and whether the file looks binary.

    All charsets of :func:`text_codecs` are considered unless ``code_pages`` names
    others; how odd a reading is is told from the bytes, and only the least odd ones
    are decoded and scored. The least noisy reading wins; readings within 1 % are told apart by language
    score, then by how many bytes became multi-byte characters, then by the order
    of trust. A file is binary when no reading stays below the noise limit.
    """
    pages = list(code_pages or text_codecs())
    read = candidates(files, content, pages)
    # Files without a reading keep a row. (An inner explode would decode twice, once to see what is empty.)
    tried = read.select(
        *key, "bom", "declared", F.octet_length(content).alias("_bytes"), F.posexplode_outer("_all").alias("_place", "_one")
    ).select("*", F.col("_one.charset").alias("charset"), F.col("_one.text").alias("_text"))
    common = "".join(sorted(basic_ideographs()))
    scored = noise_score(tried.drop("_one"), "_text", "noise", common).withColumn(
        "_wide", 1 - F.try_divide(F.length("_text"), F.col("_bytes"))
    )
    if languages is not None:
        scored = scored.withColumn("_letters", letter_counts(F.col("_text")))
    # One narrow row per reading, kept, so that no file is decoded and no reading is looked at twice.
    names = {k: f"k{i}" for i, k in enumerate(key)}
    path = scratch_path(files.sparkSession, "readings")
    scored.drop("_text").withColumnsRenamed(names).write.parquet(path)
    kept = files.sparkSession.read.parquet(path).withColumnsRenamed({new: old for old, new in names.items()})
    slim = kept.filter(F.col("_place").isNotNull()).select(*key, "_place", "charset", "noise", "_wide")
    if languages is not None:
        # Languages only matter among the least noisy readings of a file.
        level = F.floor(F.col("noise") * 100)
        least = slim.groupBy(*key).agg(F.min(level).alias("_level"))
        letters = kept.filter(F.size("_letters.letter") > 0).select(*key, "_place", "noise", "_letters")
        near = letters.join(least, key).filter(level == F.col("_level"))
        told = best_language(language_scores(near, "_letters", languages, [*key, "_place"]), [*key, "_place"])
        slim = slim.join(told, [*key, "_place"], "left")
    else:
        slim = slim.withColumns({"language": F.lit(None).cast("string"), "score": F.lit(None).cast("double")})
    order = F.struct(
        F.floor(F.col("noise") * 100).alias("a"),
        (-F.coalesce("score", F.lit(0.0))).alias("b"),
        (-F.col("_wide")).alias("c"),
        F.col("_place").alias("d"),
    )
    chosen = slim.groupBy(*key).agg(
        F.min_by(F.struct("charset", "noise", "language"), order).alias("_best"), F.min("noise").alias("_least")
    )
    first = F.coalesce("_place", F.lit(0)) == 0
    flags = kept.filter(first).select(*key, "bom", "declared", (F.col("_bytes") == 0).alias("_empty"))
    return flags.join(chosen, key, "left").select(
        *key,
        "bom",
        "declared",
        F.when(F.col("_empty"), "utf_8").otherwise(F.col("_best.charset")).alias("encoding"),
        F.coalesce("_best.noise", F.lit(0.0)).alias("noise"),
        F.col("_best.language").alias("language"),
        (~F.col("_empty") & F.coalesce(F.col("_least") >= NOISE_LIMIT, F.lit(True))).alias("binary"),
    )


def to_utf8(files: DataFrame, audit: DataFrame, key: list[str], content: str = "content") -> DataFrame:
    """(key, text): every non-binary file in its chosen encoding, as Unicode text."""
    chosen = audit.filter(~F.col("binary")).select(*key, "encoding")
    joined = files.join(chosen, key)

    @F.pandas_udf("string")
    def decode(contents: pd.Series, names: pd.Series) -> pd.Series:
        def read(data, name):
            text = bytes(data).decode(name)
            return text[1:] if text.startswith("﻿") else text

        return pd.Series([read(c, n) for c, n in zip(contents, names)], dtype=object)

    plain = F.col("encoding").isin("ascii", "utf_8")
    stripped = F.when(
        F.startswith(F.hex(F.substring(content, 1, 3)), F.lit("EFBBBF")), F.substr(content, F.lit(4))
    ).otherwise(F.col(content))
    simple = joined.filter(plain).select(*key, stripped.cast("string").alias("text"))
    paged = joined.filter(~plain).select(*key, decode(content, "encoding").alias("text"))
    return simple.unionByName(paged)
