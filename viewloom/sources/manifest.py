"""Incremental reading of landed files by a manifest.

A file is identified by its path; the manifest keeps, for every run, the size, time and checksum of the
files that the run found new, changed, only touched, or gone. A run lists what is there, compares it with
the newest row per path, and reads only the files whose size or time differ, so a file that is landed
again under its old name is read again, and one that was merely copied over is not passed on.

``documents/run=R`` holds what run R read. The manifest rows of the run are taken from it once it is
complete, so a run that dies in between is repeated by the next one and nothing is skipped.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.sources.files import list_files, with_content

ENTRY = "path string, size long, modified_at timestamp, checksum string, state string"


def _table(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def entries(spark: SparkSession, state: str) -> DataFrame:
    """All rows of the manifest: path, size, modified_at, checksum, state and run."""
    return _table(spark, f"{state}/manifest", f"{ENTRY}, run string")


def known_files(spark: SparkSession, state: str) -> DataFrame:
    """The newest row per path, without files that were gone by then. Runs are ordered by name."""
    rest = ["size", "modified_at", "checksum", "state"]
    newest = entries(spark, state).groupBy("path").agg(F.max_by(F.struct(*rest), "run").alias("last")).select("path", "last.*")
    return newest.filter(F.col("state") != "gone").drop("state")


def compare(listing: DataFrame, known: DataFrame) -> DataFrame:
    """Files that are not as the manifest says: path, size, modified_at, was (the checksum known) and
    state, which is ``new``, ``touched`` or ``gone``."""
    before = known.select("path", F.col("size").alias("old_size"), F.col("modified_at").alias("old_at"), F.col("checksum").alias("was"), F.lit(True).alias("known"))
    both = listing.withColumn("there", F.lit(True)).join(before, "path", "full")
    same = F.col("size").eqNullSafe(F.col("old_size")) & F.col("modified_at").eqNullSafe(F.col("old_at"))
    state = F.when(F.col("known").isNull(), "new").when(F.col("there").isNull(), "gone").when(~same, "touched")
    return both.withColumn("state", state).filter(F.col("state").isNotNull()).select("path", "size", "modified_at", "was", "state")


def pull(spark: SparkSession, prefixes: list[str], state: str, run: str) -> dict[str, int]:
    """One run: read what is new or changed below the prefixes into ``state/documents/run=R`` and add the
    run to the manifest. Returns the number of files per state.

    Documents have path, size, modified_at, checksum, state (``new`` or ``changed``) and content, which is
    empty for a file without bytes. A touched file with its old checksum is ``same`` and has no content;
    nor has one that is ``gone``. ``run`` names must sort by time; a run that is repeated replaces itself.
    """
    differing = compare(list_files(spark, *prefixes), known_files(spark, state))
    read = with_content(differing)
    checksum = F.sha2(F.col("content"), 256)
    settled = (
        F.when((F.col("state") == "gone") | F.col("content").isNull(), "gone")
        .when(F.col("state") == "new", "new")
        .when(checksum == F.col("was"), "same")
        .otherwise("changed")
    )
    rows = read.withColumns({"checksum": checksum, "state": settled}).drop("was")
    rows = rows.withColumn("content", F.when(F.col("state").isin("new", "changed"), F.col("content")))
    documents = f"{state}/documents/run={run}"
    rows.write.mode("overwrite").parquet(documents)
    written = spark.read.parquet(documents).drop("content")
    written.coalesce(max(1, written.rdd.getNumPartitions() // 32)).select(*[c.split()[0] for c in ENTRY.split(", ")]).write.mode("overwrite").parquet(f"{state}/manifest/run={run}")
    counted = entries(spark, state).filter(F.col("run") == run).groupBy("state").count()
    return {r["state"]: r["count"] for r in counted.collect()}


def documents(spark: SparkSession, state: str, run: str | None = None) -> DataFrame:
    """What the runs (or one run) read, as raw documents: source_path, document (null if the bytes are not
    UTF-8), modified_at, checksum, state and run."""
    found = _table(spark, f"{state}/documents", f"{ENTRY}, content binary, run string").filter(F.col("state").isin("new", "changed"))
    if run is not None:
        found = found.filter(F.col("run") == run)
    return found.select(
        F.col("path").alias("source_path"), F.try_validate_utf8(F.col("content").cast("string")).alias("document"), "modified_at", "checksum", "state", "run"
    )
