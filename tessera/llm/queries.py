"""The queries of the training-data operators: opN_<name>, each over its whole table, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, hard_negatives, html_extract, importance, jaccard_join, mixing, near_dedup, quality_model, quality_rules, sharding, topk_search, toxicity, url_filter
from .common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_by_file(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.grade_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(table(spark, sf_dir, "embeddings"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_pages(table(spark, sf_dir, "pages"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.connect(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.relabelled(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_sharding, op2_toxicity, op3_bpe, op4_quality_classifier, op5_quality_rules, op6_mixing, op7_topk_search, op8_html_extraction, op9_url_filter, op10_jaccard_join, op11_importance_resampling, op12_near_dedup, op13_hard_negatives)}
ORACLE_SQL: dict[str, str] = {"op6_mixing": mixing.ORACLE_SQL, "op5_quality_rules": quality_rules.ORACLE_SQL, "op7_topk_search": topk_search.ORACLE_SQL, "op10_jaccard_join": jaccard_join.ORACLE_SQL, "op11_importance_resampling": importance.ORACLE_SQL, "op12_near_dedup": near_dedup.ORACLE_SQL, "op13_hard_negatives": hard_negatives.ORACLE_SQL}
