"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from haulmetry.llm import archive, decontam, hnsw, lexical, linedup, maxent, merkle, minhash, mixing, oracle, quality, secrets, tokenfile, toxicity

from haulmetry.llm.common import ship


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op2_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return maxent.scores(_table(spark, folder, "documents"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linedup.line_dedup(_table(spark, folder, "documents"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op5_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfile.read_tokens(tokenfile.write_tokens(_table(spark, folder, "documents")))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mixed(_table(spark, folder, "documents"))
    return mix.select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets(_table(spark, folder, "documents"))


def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archive.read_warc(archive.convert(archive.write_arc(_table(spark, folder, "pages"))))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(_table(spark, folder, "documents")).withColumn("broken", F.concat_ws(",", "broken"))


def op11_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw.near_vectors(_table(spark, folder, "embeddings"))


def op12_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verified(_table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query per operator, and the pipeline."""
    found = {n: f for n, f in globals().items() if n.startswith("op") and n[2].isdigit()}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """SQL of those that SQL can express."""
    return oracle.SQL
