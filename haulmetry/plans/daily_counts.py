"""Quality counters kept by day: a run replaces the days of its window and leaves the others alone."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetry.operators.event_quality import COUNTERS, GROUP_KEYS, event_param_flatten, event_quality_counts

DAY = "event_date"
COUNTS_SCHEMA = ", ".join(
    [f"{key} string" for key in GROUP_KEYS if key != DAY]
    + [f"{name} bigint" for name in ("total_rows", *COUNTERS, "op_id_fill")]
    + [f"{DAY} string"]
)


def empty_days(spark: SparkSession, start: str, end: str) -> DataFrame:
    """A row without any events for each day, so that a day that has lost its events is replaced too."""
    first, last = (F.to_date(F.lit(day), "yyyyMMdd") for day in (start, end))
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("day"))
    return days.select(F.date_format("day", "yyyyMMdd").alias(DAY)).withColumn("total_rows", F.lit(0).cast("bigint"))


def write_days(counts: DataFrame, path: str) -> None:
    """Replace the days that ``counts`` holds. A large day is dealt over several tasks."""
    shaped = counts.select(*[c.split(" ")[0] for c in COUNTS_SCHEMA.split(", ")])
    dealt = shaped.hint("rebalance", DAY)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_days(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """Counters of the days of a window; other days are not read."""
    kept = spark.read.schema(COUNTS_SCHEMA).parquet(path)
    rows = kept.where(F.col(DAY).between(start, end) & (F.col("total_rows") > 0))
    return rows.select(*GROUP_KEYS, "total_rows", *COUNTERS, "op_id_fill")


def refresh_days(events: DataFrame, app_ids: Iterable[str], start: str, end: str, path: str) -> DataFrame:
    """Count the events of a window anew, replace its days in ``path``, and read them back.

    Counters are sums by day, so windows may overlap and runs may be repeated in any order: a day holds
    what the last run that covered it has counted.
    """
    spark = events.sparkSession
    counts = event_quality_counts(event_param_flatten(events, app_ids, start, end))
    write_days(counts.unionByName(empty_days(spark, start, end), allowMissingColumns=True), path)
    return read_days(spark, path, start, end)
