"""A corpus pipeline: documents to packed training bins, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvidex.llm import decontaminate, jaccard_join, packing, quality_rules, secret_scan
from corvidex.llm.common import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of the benchmark to count as contaminated."""
    return decontaminate.keep(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its bin."""
    return packing.pack(packing.measure(docs))


STAGES = [("quality_rules", quality), ("ngram_jaccard_join", near_duplicates), ("decontamination", decontamination), ("secret_scan", secrets), ("best_fit_packing", packed)]

#: The near-duplicate and packing stages have no SQL form; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
