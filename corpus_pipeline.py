"""The corpus pipeline: stages over documents, each written as Parquet and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heartwood.llm import language, mixing, packing, pii, simhash
from heartwood.llm.common import release, store, table
from heartwood.sources.readers import spread


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language go; a missing label is filled in."""
    return language.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays; copies share 0.8 of their five-word shingles."""
    return simhash.deduplicate(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to placeholders; every document stays."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them, in curriculum order."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their sequences and offsets."""
    return packing.pack(docs)


STAGES = [("language", language_id), ("near_dedup", near_dedup), ("pii", private_data), ("mix", mix), ("pack", pack)]

#: No SQL: fingerprints, language and packing are beyond it; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        after = store(stage(spark, docs, sf_dir), f"stage-{name}")
        release(docs)  # the stage before, which nothing reads any more
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
