"""A training corpus from the documents table, in five stages. Each stage is written as Parquet and read again as the next
one's documents; all but the last return the columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from claimloom.llm import byte_bpe, decontaminate, minhash_dedup, substring_dedup, toxicity
from claimloom.sources import scratch


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash_dedup.one_of_each(docs, percent=80)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words and more that occur more than once go; n_chars follows the text."""
    return substring_dedup.without_repeats(docs, width=35)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with a digest of what they decode to."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return byte_bpe.digests(byte_bpe.decode(encoded, ranks))


STAGES = [("toxicity", toxic), ("near_dedup", near_copies), ("substring_dedup", repeats), ("decontamination", leaks), ("byte_bpe", tokens)]

#: SQL can express neither the classifier nor the latent retrieval; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
