"""Corpus pipeline: five stages, each one operator, written as Parquet and read again.

Defined cases, in every stage: null and empty texts, null and repeated ids, repeated rows, an
empty table and further columns, whatever their names, don't fail. All stages but the last
return the columns that they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import decontaminate, packing, quality_rules, secret_scan, simhash_dedup
from ledgerspark.llm._common import bounded_batches, delete_path, fresh_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the quality rules. Null and empty texts fail; repeated rows all stay or all go."""
    return quality_rules.kept_rows(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the row with the smallest id, then text; null ids come last.

    Null and empty texts are one group (fingerprint zero); of repeated rows one stays; rows that share an id but not a group all stay.
    """
    return simhash_dedup.one_per_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item. Null and empty texts hold none; repeated rows all stay or all go."""
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets masked and n_chars, where there is such a column, counted anew; a null text stays null and so does its count."""
    bounded_batches(spark)
    masked = docs.withColumn("text", secret_scan.redacted(F.col("text")))
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences; a null or empty text is its end id alone; repeated rows are packed each."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("simhash_dedup", dedup),
    ("decontaminate", decontaminated),
    ("secret_scan", secrets_masked),
    ("packing", packed),
]

#: Tokenizing and BM25 retrieval have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again; the last one's stays there."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
