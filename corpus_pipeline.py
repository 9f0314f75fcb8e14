"""A training-data pipeline: rules, near-duplicates, decontamination, mixing and binary output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haulmetry.llm import decontam, minhash, mixing, quality, tokenfile
from haulmetry.llm.common import ship, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    ship(spark)
    return minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    return decontam.decontaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixture(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what they hold, per document."""
    ship(spark)
    return tokenfile.read_tokens(tokenfile.write_tokens(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs


ORACLE_SQL = None
