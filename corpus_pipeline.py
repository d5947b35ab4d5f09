"""The corpus pipeline: quality, near duplicates, decontamination, mixing, token ids. Each stage reads what the one before wrote.

Null and empty texts, rows with a null doc_id and rows that repeat one go through every stage by the rules that its operator
states; an empty table gives an empty result. All stages but the last keep the columns of documents, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prumo.llm import decontaminate, mixing, ngram_join, quality, token_store
from prumo.llm.common import discard, materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, doesn't reject; null and empty texts are scored, too."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more, smallest doc_id. Texts without
    words and rows with a null doc_id stay."""
    return ngram_join.keep_one(docs, k=5, num=4, den=5)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; null texts and rows with a null doc_id are clean."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for; a null source is one of its own."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in shards, and where each document lies in them; a null text has its end id only."""
    return token_store.tokens(docs)


STAGES = [("quality", keep_good), ("near_duplicates", keep_first), ("decontamination", keep_clean), ("mixing", mix), ("token_ids", encode)]

#: Models, tokenizer and links can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)  # what the stage read
        before = docs
    return docs
