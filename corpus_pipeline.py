"""From raw documents to packed training sequences, one operator per stage.

Each stage takes what its predecessor kept and returns the columns of ``documents``; the last returns
one row per packed piece. Null ids, null texts and empty tables pass through as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm import hyper_lang, order_minhash, pattern_pack, phrase_index, secret_layers
from viewloom.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Texts are rejected if they have no letters or are this far from every language. Clean prose, even a
#: single sentence, stays well above; what lies below has hardly any letter group of any language.
LEAST_SCORE = 0.05


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents in a learned language."""
    labelled = hyper_lang.identify(_columns(docs), carried=COLUMNS)
    known = (F.col("lang_pred") != hyper_lang.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return _columns(labelled.filter(known))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates."""
    return order_minhash.keep_first(_columns(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents without a passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return phrase_index.without_passages(_columns(docs), items)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets, also encoded ones, in the texts."""
    found = secret_layers.find_secrets(_columns(docs), carried=COLUMNS)
    text = secret_layers.masked(F.col("text"), F.col("spans"))
    return _columns(found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining texts in sequences of at most 1024 tokens, one row per piece."""
    return pattern_pack.pack(docs)


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("best-fit packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; what each keeps is written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        kept = stage(spark, docs, sf_dir)
        if number + 1 == len(STAGES):
            return kept
        folder = scratch_path(spark, "stage")
        kept.write.mode("overwrite").parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
