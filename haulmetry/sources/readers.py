"""Readers: lazy DataFrames with declared schemas, so filters and columns reach the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetry.sources.schemas import SCHEMAS, conform


def event_window(as_of: dt.date, lookback_days: int = 3) -> tuple[str, str]:
    """First and last day (``yyyyMMdd``) of the trailing window that ends the day before ``as_of``."""
    first, last = as_of - dt.timedelta(days=lookback_days), as_of - dt.timedelta(days=1)
    return first.strftime("%Y%m%d"), last.strftime("%Y%m%d")


def read_app_events(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """Nested events between two days. ``path`` is partitioned by ``event_date``, so other days are not read."""
    # The partition column may be inferred as a number from its folder names.
    events = spark.read.parquet(path)
    day = F.col("event_date")
    if events.schema["event_date"].dataType.simpleString() == "string":
        return conform(events.where(day.between(start, end)), "app_events")
    pruned = events.where(day.between(int(start), int(end)))
    return conform(pruned.withColumn("event_date", day.cast("string")), "app_events")


def read_table(spark: SparkSession, location: str, name: str) -> DataFrame:
    """One source table from a Parquet path or a catalog name."""
    df = spark.read.parquet(location) if "/" in location else spark.table(location)
    return conform(df, name)


def read_tables(spark: SparkSession, locations: Mapping[str, str]) -> dict[str, DataFrame]:
    """Source tables by neutral name, from ``{neutral name: path or catalog table}``."""
    unknown = sorted(set(locations) - set(SCHEMAS) - {"release_events_history", "release_events_current"})
    if unknown:
        raise ValueError(f"unknown source tables {unknown}")
    tables = {}
    for name, location in locations.items():
        declared = "release_events" if name.startswith("release_events") else name
        tables[name] = read_table(spark, location, declared)
    return tables


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    name: str,
    split_column: str,
    lower: str,
    upper: str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """One source table over JDBC, read in parallel ranges of ``split_column``."""
    reader = spark.read.format("jdbc").options(
        url=url,
        dbtable=table,
        partitionColumn=split_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=str(partitions),
        **options,
    )
    return conform(reader.load(), name)
