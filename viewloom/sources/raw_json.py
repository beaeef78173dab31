"""Raw zone: JSON documents, one per file, each a list of records or one record.

Documents become rows of variant records, so type drift between files does not
break a run; broken documents go to quarantine without stopping the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from viewloom.session import scratch_path
from viewloom.sources.files import is_listable, list_files, write_files
from viewloom.sources.sinks import rebalanced

JSON_FILES = "*.[jJ][sS][oO][nN]"

# Strict JSON: no single quotes, no NaN.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "allowUnquotedFieldNames": "false"}


def read_documents(spark: SparkSession, prefix: str) -> DataFrame:
    """All ``.json`` files (any case) below a prefix: path, text, modification time.

    Text is null when the bytes are not UTF-8, which quarantines the file. Files
    without bytes, which Spark's readers pass over, come as empty text.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", JSON_FILES)
        .option("recursiveFileLookup", "true")
        .load(prefix)
    )
    read = files.select(
        F.col("path").alias("source_path"),
        F.try_validate_utf8(F.col("content").cast("string")).alias("document"),
        F.col("modificationTime").alias("modified_at"),
    )
    return read.unionByName(empty_files(spark, prefix))


def empty_files(spark: SparkSession, prefix: str) -> DataFrame:
    """The ``.json`` files without bytes, by a listing on the executors. In a store that only Spark reads
    none are found."""
    if not is_listable(prefix):
        return spark.createDataFrame([], "source_path string, document string, modified_at timestamp")
    found = list_files(spark, prefix).filter((F.col("size") == 0) & F.lower("path").endswith(".json"))
    return found.select(F.col("path").alias("source_path"), F.lit("").alias("document"), "modified_at")


def record_array(document: str) -> Column:
    """The records of one document: list elements, or the value itself.

    Null when the document cannot be parsed; an empty list gives no records. A list
    is parsed element by element, so only a single record is bound by the size of a
    variant, and strings, numbers and nulls keep their types.
    """
    text = F.col(document)
    listed = F.from_json(text, "array<variant>", STRICT)
    value = F.try_parse_json(text)
    return F.when(F.rlike(text, F.lit(r"^\s*\[")), listed).when(value.isNotNull(), F.array(value))


def is_broken(records: str = "records") -> Column:
    return F.col(records).isNull()


def parse_documents(df: DataFrame, document: str = "document") -> DataFrame:
    return df.withColumn("records", record_array(document)).drop(document)


def explode_records(parsed: DataFrame) -> DataFrame:
    """One row per record with its position in the document."""
    others = [c for c in parsed.columns if c != "records"]
    # The outer form keeps the optimizer from parsing twice for a size check.
    rows = parsed.select(*others, F.posexplode_outer("records").alias("record_no", "record"))
    return rows.filter(F.col("record_no").isNotNull())


def json_line(record: str = "record") -> Column:
    """One JSON Lines row; explicit nulls stay."""
    return F.to_json(F.col(record))


def without_extension(path: Column) -> Column:
    """Drop the last extension of the file name; leading dots do not count."""
    return F.regexp_replace(path, r"^(.*/)?(\.*[^./][^/]*)\.[^./]*$", "$1$2")


def target_path(path: Column, raw: str = "raw/", processed: str = "processed/") -> Column:
    """``raw/x.json`` -> ``processed/x.jsonl``; a path without the prefix keeps its place."""
    return F.concat(F.replace(without_extension(path), F.lit(raw), F.lit(processed)), F.lit(".jsonl"))


def feed_of(path: Column) -> Column:
    """The folder that holds the file."""
    return F.element_at(F.split(path, "/"), -2)


def to_lines(documents: DataFrame, raw: str = "raw/", processed: str = "processed/") -> DataFrame:
    """(source_path, target_path, record_no, line) for every record."""
    return explode_records(parse_documents(documents)).select(
        "source_path",
        target_path(F.col("source_path"), raw, processed).alias("target_path"),
        "record_no",
        json_line().alias("line"),
    )


def conversion_log(documents: DataFrame) -> DataFrame:
    """Per file: was it readable, and how many records did it hold."""
    return parse_documents(documents).select(
        "source_path",
        F.when(is_broken(), "quarantined").otherwise("converted").alias("status"),
        F.coalesce(F.size("records"), F.lit(0)).cast("bigint").alias("records"),
    )


def run_metrics(log: DataFrame) -> DataFrame:
    """Files and records per folder and status."""
    return log.groupBy(feed_of(F.col("source_path")).alias("feed"), "status").agg(
        F.count(F.lit(1)).alias("files"), F.sum("records").alias("records")
    )


def backfill(documents: DataFrame, out: str) -> dict:
    """Write every readable record as a JSON line and every broken file as a
    quarantine line, in one pass: ``out/status=converted/feed=...`` and
    ``out/status=quarantined/feed=...``. Returns the counts of the run."""
    parsed = parse_documents(documents)
    seen = Observation()
    counted = parsed.observe(
        seen,
        F.count(F.lit(1)).alias("files"),
        F.count_if(is_broken()).alias("quarantined"),
        F.coalesce(F.sum(F.greatest(F.size("records"), F.lit(0))), F.lit(0)).alias("records"),
    )
    complaint = F.to_json(F.struct("source_path", F.lit("not a JSON document").alias("reason")))
    lines = F.when(is_broken(), F.array(complaint)).otherwise(
        F.transform("records", lambda record: F.to_json(record))
    )
    rows = counted.select(
        F.explode(lines).alias("value"),
        F.when(is_broken(), "quarantined").otherwise("converted").alias("status"),
        feed_of(F.col("source_path")).alias("feed"),
    )
    rebalanced(rows, "status", "feed").write.mode("overwrite").partitionBy("status", "feed").text(out)
    return seen.get


def line_files(documents: DataFrame, raw: str = "raw/", processed: str = "processed/") -> DataFrame:
    """(source_path, target_path, mark, lines): the JSON Lines file that each document becomes. A target
    keeps the whole path of its source; ``lines`` is null for a broken document."""
    marked = documents.select("source_path", "document", F.xxhash64("document").alias("mark"))
    return parse_documents(marked).select(
        "source_path",
        target_path(F.col("source_path"), raw, processed).alias("target_path"),
        "mark",
        F.transform("records", lambda record: F.to_json(record)).alias("lines"),
    )


def taken_names(files: DataFrame) -> DataFrame:
    """(target_path, owner): targets that more than one document would become, and the (source_path,
    mark) of the one that does: the path that sorts first."""
    source = F.struct("source_path", "mark")
    readable = files.filter(F.col("lines").isNotNull() & F.col("target_path").isNotNull())
    owners = readable.groupBy("target_path").agg(F.min(source).alias("owner"), F.max(source).alias("last"))
    return owners.filter(~F.col("owner").eqNullSafe(F.col("last"))).drop("last")


def write_line_files(documents: DataFrame, out: str, raw: str = "raw/", processed: str = "processed/") -> dict:
    """Write each readable document as one JSON Lines file of its own name, ``.../raw/a/x.json`` as
    ``out/files/.../processed/a/x.jsonl``, and add a line for each other document to ``out/quarantine``:
    broken ones, ones without a path, and ones whose name another document has. Returns the counts.

    Executors write the files. Names are compared without the documents; only names that are taken meet
    them again. A later run replaces only the files it has.
    """
    spark = documents.sparkSession
    folder = scratch_path(spark, "line-files")
    line_files(documents, raw, processed).write.parquet(folder)
    found = spark.read.parquet(folder)
    joined = found.join(taken_names(found), "target_path", "left")
    reason = (
        F.when(F.col("lines").isNull(), "not a JSON document")
        .when(F.col("target_path").isNull(), "no path")
        .when(F.col("owner").isNotNull() & ~F.struct("source_path", "mark").eqNullSafe(F.col("owner")), "name is taken")
    )
    joined = joined.withColumn("reason", reason)
    text = F.concat(F.array_join("lines", "\n"), F.when(F.size("lines") > 0, "\n").otherwise(""))
    below = F.regexp_replace("target_path", r"^(?:[a-z0-9]+:)?/*", "")
    files = joined.filter(F.col("reason").isNull()).select(F.concat(F.lit(f"{out}/files/"), below).alias("path"), text.alias("content"))
    written = write_files(files)
    rejected = joined.filter(F.col("reason").isNotNull()).select(F.to_json(F.struct("source_path", "reason")).alias("value"))
    seen = Observation()
    rebalanced(rejected.observe(seen, F.count(F.lit(1)).alias("quarantined"))).write.mode("append").text(f"{out}/quarantine")
    return {"files": written["files"], "quarantined": seen.get["quarantined"]}
