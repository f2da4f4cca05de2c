"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedwright.llm import (
    bpe_replay,
    exact_dedup,
    fertility,
    packing,
    periodic_runs,
    quality_cotrain,
    sharding,
    simhash_mih,
    suffix_dedup,
    token_counts,
    toxicity,
    url_lists,
    whitening,
)
from feedwright.llm.common import documents


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digest(documents(spark, sf_dir))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(documents(spark, sf_dir))


def op3_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cotrain.classify(documents(spark, sf_dir), _labels(spark, sf_dir))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op5_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_lists.page_verdicts(spark, sf_dir)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), _labels(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_mih.near_duplicates(documents(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), sums="library")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality_rules(documents(spark, sf_dir))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_replay.round_trip_digest(documents(spark, sf_dir))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(documents(spark, sf_dir))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.runs_digest(documents(spark, sf_dir))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_array_dedup, op2_exact_dedup, op3_quality_cotraining, op4_packing, op5_url_lists, op6_toxicity, op7_simhash,
    op8_token_counts, op9_quality_rules, op10_byte_bpe, op11_sharding, op12_periodic_runs, op13_whitening)}

ORACLE_SQL = {"op2_exact_dedup": exact_dedup.SQL, "op5_url_lists": url_lists.SQL}
