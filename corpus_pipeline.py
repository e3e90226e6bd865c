"""From raw documents to a training mix, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as Parquet to
the shared folder and reads it back as the next stage's documents. A stage begins by deleting the
intermediate tables of the one before, so a result has to be written before the next stage is called.
All but the last return the columns of ``documents``; each works on all that its predecessor kept:

1. ``language_id`` drops documents without a letter or with less than half of their letters in one
   known language.
2. ``jaccard_join`` keeps one document, that with the smallest id, of each group of near duplicates.
3. ``suffix_dedup`` removes runs of 50 words, and strings of 400 bytes (of scripts without spaces,
   too), that still occur more than once; a document that becomes blank goes. Changed texts get a new
   ``n_chars``.
4. ``decontaminate`` drops documents in which ten consecutive words of a benchmark item occur.
5. ``mixing`` takes documents of each source up to its target and adds ``copies``.

Null texts have no language and go in the first stage; rows that repeat an id count as documents of
their own throughout. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.llm import decontaminate as winnowing, jaccard_join as jaccard, language_id as language, mixing as mix
from starmill.llm import suffix_dedup as suffixes
from starmill.llm.tables import stage, staged

REPEATED_WORDS = 50


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with stage(spark):
        return language.keep_known(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with stage(spark):
        return jaccard.keep_one(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with stage(spark):
        short = suffixes.drop_repeats(docs, words=REPEATED_WORDS)
        return short.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with stage(spark):
        return winnowing.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with stage(spark):
        return mix.mixed(docs)


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("suffix_dedup", suffix_dedup),
    ("decontaminate", decontaminate),
    ("mixing", mixing),
]

# Viterbi over learned scores cannot be put into SQL; the tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = staged(step(spark, docs, sf_dir), f"stage-{name}")
    return docs
