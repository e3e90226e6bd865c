"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from starmill.llm import decontaminate, jaccard_join, language_id, licenses, lsh_forest, merkle, mixing, nearest, prefix_trie, quality, suffix_dedup, token_counts, warc
from starmill.llm.oracles import ORACLES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _reachable(spark: SparkSession) -> None:
    """Python workers import this package; in a session started in another folder they need its place."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(_table(spark, sf_dir, "pages"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.digest(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(_table(spark, sf_dir, "documents"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(_table(spark, sf_dir, "embeddings"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.digest(_table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.with_suffix_sums(token_counts.histogram(_table(spark, sf_dir, "documents")))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(_table(spark, sf_dir, "documents"))


def op12_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.digest(_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.digest(_table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    _reachable(spark)
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_licenses": op2_licenses,
    "op3_warc": op3_warc,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_quality": op5_quality,
    "op6_decontaminate": op6_decontaminate,
    "op7_mixing": op7_mixing,
    "op8_nearest": op8_nearest,
    "op9_language_id": op9_language_id,
    "op10_token_counts": op10_token_counts,
    "op11_merkle": op11_merkle,
    "op12_lsh_forest": op12_lsh_forest,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": pipeline,
}

if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
