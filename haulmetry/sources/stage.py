"""Intermediate tables that several outputs read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Stage:
    """Tables of one run, written to a folder that driver and executors share.

    A written table survives lost executors and keeps column pruning and size statistics for its
    readers. ``clear`` deletes what the run has written, once its outputs are.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        folder = folder or spark.conf.get("spark.checkpoint.dir", "")
        if not folder:
            raise ValueError("name a shared folder, or set spark.checkpoint.dir")
        self._spark, self._folder, self._paths, self._tables = spark, folder.rstrip("/"), [], []

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` once and go on from the written table."""
        path = f"{self._folder}/haulmetry-{uuid.uuid4().hex}"
        self._paths.append(path)
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def keep_bucketed(self, df: DataFrame, key: str, buckets: int, one_each: bool = False) -> DataFrame:
        """Write ``df`` once, dealt and sorted by ``key``: tables of as many buckets join on it without a shuffle.

        A bucket is read by one task. Where one key holds more rows than two buckets should, the table is
        written plain, and joins shuffle it and split that key as always. A table of one row for each key
        (``one_each``) need not be counted for that.
        """
        if not one_each:
            # Rows without a key are a group too.
            sizes = df.groupBy(key).agg(F.count("*").alias("n"))
            largest, total = sizes.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
            if largest > max(2 * total / buckets, 1000):
                return self.keep(df)
        name = f"haulmetry_{uuid.uuid4().hex}"
        path = f"{self._folder}/{name}"
        self._paths.append(path)
        self._tables.append(name)
        # Dealt beforehand, so that a bucket is one file.
        dealt = df.repartition(buckets, key)
        dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
        return self._spark.table(name)

    def clear(self) -> None:
        """Delete the tables of this run."""
        for name in self._tables:
            self._spark.sql(f"drop table if exists {name}")
        self._tables = []
        for name in self._paths:
            path = self._spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)
        self._paths = []
