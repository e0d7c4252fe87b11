"""The corpus pipeline: quality rules, near-duplicate removal, benchmark
decontamination, secret redaction and packing, one stage after the other.

Every stage but the last keeps the columns of documents. Each is a function of
(spark, docs, sf_dir); its result is written as Parquet and read again as the
next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyline.llm import decontamination, near_dedup, packing, quality, secret_scan
from tallyline.llm.common import new_folder, table
from tallyline.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or that the isolation forest finds
    unlike the good labelled ones, go."""
    docs = docs.select(*COLUMNS)
    return quality.filter_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the least doc_id stays."""
    return near_dedup.drop_near_duplicates(docs.select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window like a benchmark item go."""
    return decontamination.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live secrets are masked in the text; every document stays."""
    return secret_scan.redact(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, and their places in sequences."""
    return packing.pack_documents(docs.select(*COLUMNS), tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("packing", pack),
]

#: SQL expresses neither the forest nor the tokenizer; tests/llm holds the
#: pipeline against a version in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
