"""The registered queries of this subpackage: each applies an operator, with its production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heartwood.llm import alignment, counts, embeddings, katz, language, manifest, mixing, packing, pii, secrets, sharding, simhash, topk
from heartwood.llm.common import table
from heartwood.sources.readers import spread


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op2_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(documents(spark, sf_dir))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.digest(documents(spark, sf_dir))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(documents(spark, sf_dir))


def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(documents(spark, sf_dir))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(documents(spark, sf_dir))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.digest(documents(spark, sf_dir))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count(documents(spark, sf_dir))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_embedding_links, op3_feistel_shards, op4_pack, op5_top_k, op6_pii, op7_language, op8_mix_sources, op9_katz, op10_secrets, op11_merkle, op12_token_counts, op13_alignment)}
ORACLES = {"op5_top_k": topk.ORACLE, "op8_mix_sources": mixing.ORACLE, "op10_secrets": secrets.ORACLE, "op11_merkle": manifest.ORACLE}
