"""The queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import basket_itemsets, decontaminate, jaccard_join, packing, quality_rules, rule_ensemble, secret_scan, sharding, spelling_variants, substring_dedup, suffix_dedup, suffix_tree_lm, toxicity
from .sql import SQL  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.repeats(_table(spark, sf_dir, "documents")))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.classes(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(_table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the newest version of the store reads, after arrivals, merges and a vacuum."""
    store, manifest = sharding.round_trip(_table(spark, sf_dir, "documents"))
    return store.read(manifest.version).select("doc_id", "lang", "source", "n_chars", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op5_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.score(_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find(_table(spark, sf_dir, "documents")))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.measure(_table(spark, sf_dir, "documents")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_policy(quality_rules.ledger(_table(spark, sf_dir, "documents"))).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_bits")


def op11_basket_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return basket_itemsets.digest(basket_itemsets.itemsets(_table(spark, sf_dir, "sale_lines")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(_table(spark, sf_dir, "documents"))


def op13_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return rule_ensemble.score(docs, rule_ensemble.learn(docs, _table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_suffix_array_dedup, op2_substring_dedup, op3_ngram_jaccard_join, op4_sharding, op5_suffix_tree_lm, op6_secret_scan, op7_decontaminate, op8_best_fit_packing, op9_toxicity, op10_quality_rules, op11_basket_itemsets, op12_spelling_variants, op13_rule_ensemble)
}
