"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from offerloom.llm import (alignment, decontaminate, merkle, mixing, quality_neighbours, rule_forest, secret_scan, sharding, simhash_dedup,
                           substring_dedup, token_counts, topk, toxicity)
from offerloom.llm.common import table
from offerloom.llm.oracles import DECONTAMINATION_SQL, MANIFEST_SQL, MIXING_SQL, SUBSTRING_SQL, TOP_K_SQL

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return register


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query("op2_quality_neighbours")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_neighbours.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_simhash_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_digest(table(spark, sf_dir, "documents"))


@query("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_forest.rule_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_benchmark_decontamination", DECONTAMINATION_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_substring_dedup", SUBSTRING_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_digest(table(spark, sf_dir, "documents"))


@query("op7_source_mixing", MIXING_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


@query("op8_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(table(spark, sf_dir, "documents"))


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_histogram_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


@query("op11_merkle_manifest", MANIFEST_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_digest(table(spark, sf_dir, "documents"))


@query("op12_tokenizer_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digest(table(spark, sf_dir, "documents"))


@query("op13_topk_search", TOP_K_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))
