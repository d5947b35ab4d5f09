"""Queries of this subpackage, each over its whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prumo.llm import decontaminate, exact_dedup, fill_in_middle, hmm_lm, licenses, line_dedup, mixing, ngram_join, periodic_runs, quality, substring_dedup, token_counts, token_store


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.digest(_documents(spark, sf_dir))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(_documents(spark, sf_dir))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(_documents(spark, sf_dir))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.digest(_documents(spark, sf_dir))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.digest(_documents(spark, sf_dir))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.digest(_documents(spark, sf_dir))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(_documents(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(_documents(spark, sf_dir))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.digest(_documents(spark, sf_dir))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(_documents(spark, sf_dir))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest(_documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_mixing, op3_license_scan, op4_quality_classifier, op5_exact_dedup, op6_token_store, op7_decontaminate, op8_hmm_lm, op9_substring_dedup, op10_line_dedup, op11_token_counts, op12_periodic_runs, op13_fill_in_middle)}
ORACLE_SQL = {"op1_ngram_join": ngram_join.SQL, "op2_mixing": mixing.SQL, "op5_exact_dedup": exact_dedup.SQL, "op9_substring_dedup": substring_dedup.SQL, "op10_line_dedup": line_dedup.SQL, "op13_fill_in_middle": fill_in_middle.SQL}
