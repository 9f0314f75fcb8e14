"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings: all may be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split hot join partitions even where that costs one more exchange: joins here
    # are chained on demand and trip keys, and one key may hold a third of the rows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # The JVM never compiles methods over 8,000 bytes. Stages with dozens of counters or rules
    # exceed that when fused; run unfused they are generated in small pieces and go faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "haulmetry", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; on a cluster leave ``master`` to the submitter."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
