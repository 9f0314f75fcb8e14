"""Quality counters from a stream of event files, kept in the same days as those of the batch."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from haulmetry.operators.event_quality import COUNTERS, GROUP_KEYS, event_param_flatten, event_quality_counts
from haulmetry.plans.daily_counts import COUNTS_SCHEMA, DAY, write_days
from haulmetry.sources.schemas import schema

#: Events may come so much later than the latest day seen and still count.
LATENESS = "3 days"
_COUNTED = ("total_rows", *COUNTERS, "op_id_fill")


def read_event_stream(spark: SparkSession, path: str, files_per_batch: int = 1_000) -> DataFrame:
    """New event files as they come, with the declared columns."""
    return spark.readStream.schema(schema("app_events")).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def running_counts(events: DataFrame, app_ids: Iterable[str], start: str, end: str, lateness: str = LATENESS) -> DataFrame:
    """Counters so far of every group that new events change; groups of days past the watermark are let go."""
    flat = event_param_flatten(events, app_ids, start, end)
    dated = flat.withColumn("day", F.to_timestamp(DAY, "yyyyMMdd")).withWatermark("day", lateness)
    return event_quality_counts(dated, "day").drop("day")


def merge_days(changed: DataFrame, path: str) -> None:
    """Bring changed groups into the days of ``path``; other days are neither read nor written.

    A group's counters only grow, so the newest are the greatest: merging a batch once more, as after a
    restart, changes nothing.
    """
    spark = changed.sparkSession
    days = [r[0] for r in changed.select(DAY).distinct().toLocalIterator()]  # a batch touches a few days
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    merged = changed.select(*GROUP_KEYS, *_COUNTED)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        kept = spark.read.schema(COUNTS_SCHEMA).parquet(path).where(F.col(DAY).isin(*days))
        merged = merged.unionByName(kept.select(*GROUP_KEYS, *_COUNTED))
    write_days(merged.groupBy(*GROUP_KEYS).agg(*[F.max(c).alias(c) for c in _COUNTED]), path)


def start_counting(
    events: DataFrame,
    app_ids: Iterable[str],
    start: str,
    end: str,
    path: str,
    checkpoint: str,
    lateness: str = LATENESS,
    available_now: bool = True,
) -> StreamingQuery:
    """Count a stream of events into ``path``; read it with ``daily_counts.read_days``.

    State and progress are in ``checkpoint``, a shared folder: a query started again goes on where the last
    one ended. Events later than ``lateness`` are not counted; ``refresh_days`` counts their days anew.
    """

    def merge(changed: DataFrame, _: int) -> None:
        changed.persist()
        if not changed.isEmpty():
            merge_days(changed, path)
        changed.unpersist()

    writer = running_counts(events, app_ids, start, end, lateness).writeStream.outputMode("update").foreachBatch(merge)
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
