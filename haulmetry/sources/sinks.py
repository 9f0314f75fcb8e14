"""Sinks: refresh-stamped tables, published together in one commit, and CSV exports."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The dashboard's output names, in report order.
OUTPUT_NAMES = (
    "dmg_raw",
    "tickets",
    "trip_end_raw",
    "can_raw",
    "sub_raw",
    "fo_tkts",
    "avg_quotes",
    "acq_pod_dod",
    "acq_pod_wow",
    "acq_pod_mom",
    "Call_fo",
    "advance_op_payment",
    "bal_op_payment",
)

# The column that each output is ordered by, latest first; a missing one counts as the latest.
ORDERED_BY = {
    "dmg_raw": "daily_trip",
    "tickets": "ticket_created_time",
    "trip_end_raw": "unloading_done_time",
    "can_raw": "placement_time",
    "sub_raw": "s_date",
    "fo_tkts": "placement_date",
    "avg_quotes": "quote_date",
    "acq_pod_dod": "subs_date",
    "acq_pod_wow": "subs_week",
    "acq_pod_mom": "subs_month",
    "Call_fo": "day",
    "advance_op_payment": "month",
    "bal_op_payment": "month",
}
MANIFEST, RUNS = "manifest.json", "runs"


def latest_first(name: str) -> list[Column]:
    """Order of a dashboard output."""
    return [F.col(ORDERED_BY[name]).desc_nulls_first()]


def in_order(df: DataFrame, order: Sequence[Column], parts: int | None = None) -> DataFrame:
    """Rows such that files read in the order of their names are sorted, without a single task for the sort.

    Partitions are ranges of the order. Rows equal in it, of one date say, are told apart by their
    place, so they are spread over partitions too.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("_row", F.monotonically_increasing_id())
    return placed.repartitionByRange(parts, *order, "_row").sortWithinPartitions(*order).drop("_row")


def stamped(df: DataFrame, refreshed_at: dt.datetime) -> DataFrame:
    """Add the run time to every row."""
    return df.withColumn("refreshed_at", F.lit(refreshed_at).cast("timestamp_ntz"))


def publish(
    df: DataFrame, root: str, name: str, refreshed_at: dt.datetime, order: Sequence[Column] | None = None
) -> str:
    """Overwrite one named output, stamped with its run time; returns its path."""
    if name not in OUTPUT_NAMES:
        raise ValueError(f"unknown output {name}")
    path = f"{root.rstrip('/')}/{name}"
    rows = stamped(df, refreshed_at)
    (in_order(rows, order) if order else rows).write.mode("overwrite").parquet(path)
    return path


def publish_together(outputs: Mapping[str, DataFrame], root: str, refreshed_at: dt.datetime, ordered: bool = True) -> dict[str, str]:
    """Write all outputs to a folder of this run and make them the published ones at once; returns their paths.

    Readers go by the manifest, which is replaced by one rename after the last output is written. Until
    then, and where a run fails, they read the outputs of the run before, all of them.
    """
    unknown = sorted(set(outputs) - set(OUTPUT_NAMES))
    if unknown:
        raise ValueError(f"unknown outputs {unknown}")
    root, run = root.rstrip("/"), f"{refreshed_at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex}"
    paths = {n: publish(df, f"{root}/{RUNS}/{run}", n, refreshed_at, latest_first(n) if ordered else None) for n, df in outputs.items()}
    spark = next(iter(outputs.values())).sparkSession
    _replace_text(spark, f"{root}/{MANIFEST}", json.dumps({"run": run, "refreshed_at": refreshed_at.isoformat(), "outputs": list(outputs)}))
    return paths


def published_run(spark: SparkSession, root: str) -> dict | None:
    """Run, run time and output names of what is published, or None."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{MANIFEST}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return json.loads(spark.read.text(path.toString(), wholetext=True).first()[0])


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One output of the run that is published."""
    run = published_run(spark, root)
    if run is None or name not in run["outputs"]:
        raise ValueError(f"{name} is not published in {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{RUNS}/{run['run']}/{name}")


def drop_old_runs(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the runs, failed ones too, but for the ``keep`` newest and the published one; returns their names.

    Of runs of the same time, the published one is the newest.
    """
    run = published_run(spark, root)
    published = run and run["run"]
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{RUNS}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []
    names.sort(key=lambda n: (n.split("-")[0], n == published, n))
    old = [n for n in names[: max(0, len(names) - keep)] if n != published]
    for name in old:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, name), True)
    return old


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place and rename it over the old one."""
    fs = spark._jvm.org.apache.hadoop.fs
    target, new = fs.Path(path), fs.Path(f"{path}.{uuid.uuid4().hex}")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(files.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration()).rename(new, target, options)


def export_csv(df: DataFrame, path: str) -> None:
    """Distinct rows to CSV; an empty frame still writes its header."""
    df.dropDuplicates().write.mode("overwrite").option("header", True).csv(path)
