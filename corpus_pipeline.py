"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, token files.

Each stage takes what its predecessor kept, as Parquet, and returns a DataFrame; the last returns one row
per document written (a document that the mix takes twice is written twice).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reconlake.llm import language, mixing, simhash, templates, token_files
from reconlake.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
#: (1 + cosine) / 2 with the nearest language: rejected if a text is not nearer to it than to none.
LEAST_LANGUAGE_SCORE = 0.5
#: Share of the learned documents of a language that may lie below the cosine asked of its documents.
LANGUAGE_QUANTILE = 0.001


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those that resemble no language of the corpus."""
    found = language.learn(docs)
    least = language.least_nearness(docs, found, LANGUAGE_QUANTILE)
    return language.identified(docs, found, LEAST_LANGUAGE_SCORE, least=least)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return simhash.NearDuplicates(docs).kept()


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return templates.Leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).clean()


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents so that sources have their target shares of words."""
    return mixing.Mix(docs).documents()


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and reads each document's place, length and checksum back from them."""
    path = scratch_path(spark, "pipeline-tokens")
    token_files.write_tokens(docs, path, public_tokenizers.path(TOKENIZER))
    return token_files.read_digests(spark, path)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", write_tokens),
]

#: Profiles, fingerprints and tokens cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        at = scratch_path(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
