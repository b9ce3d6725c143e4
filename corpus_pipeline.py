"""A corpus from raw documents: quality rules, near duplicates, benchmark passages, secrets, and the mix of sources.

Every stage takes what its predecessor kept, as read from the shared folder, and all but the last return the columns of
``documents``. The last draws documents by their calibrated weight and adds ``mix_topic`` and ``mix_weight``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daypanel.llm import decontaminate, jaccard_join, quality_ledger, secret_scan, source_mix
from daypanel.session import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go."""
    return quality_ledger.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays, the one with the smallest id."""
    return jaccard_join.keep_one_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; documents stay."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; documents stay."""
    return secret_scan.redact(docs)


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn so that sources, languages and topics come near their target weights."""
    return source_mix.mix(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("secrets", secrets),
    ("source_weights", source_weights),
]

#: Trained models take part, which SQL cannot express; tests/llm holds the pipeline against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
