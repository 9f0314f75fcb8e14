"""App versions: which ones the audit follows, when each was released, and tagging rows with them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmetry.functions.rows import rows_of_listed
from haulmetry.functions.text import version_key

# The debug build left out, the audited platform, and the size of the version list.
DEBUG_VERSIONS = ("1.1.0 debug",)
PLATFORM = "android"
OTHER_VERSIONS = 9


def platform_rows(
    counts: DataFrame, platform: str = PLATFORM, debug_versions: Iterable[str] = DEBUG_VERSIONS
) -> DataFrame:
    """Counter rows of one platform without debug builds; rows without a version are no debug build."""
    debug = F.coalesce(F.col("app_version").isin(*debug_versions), F.lit(False))
    return counts.where(~debug & (F.col("event_platform") == platform))


def _order(numeric: bool) -> tuple[Column, ...]:
    version = F.col("app_version")
    return (version_key(version), version) if numeric else (version,)


def app_version_rank(
    counts: DataFrame,
    latest_version: str | None = None,
    others: int = OTHER_VERSIONS,
    drop_lowest: bool = True,
    numeric_order: bool = True,
    released: DataFrame | None = None,
) -> DataFrame:
    """One latest version plus the largest others by rows, labelled ``app_latest_<n>`` from newest.

    ``latest_version`` defaults to the highest version, or with ``released`` (``app_version``,
    ``release_date``) to the one released last; versions without a date come before. The lowest version is left out first
    when ``drop_lowest`` is set. At most ``others + 1`` rows come back.
    """
    version = F.col("app_version")
    sizes = (
        platform_rows(counts)
        .where(version.isNotNull())
        .groupBy("app_version")
        .agg(F.sum("total_rows").cast("bigint").alias("total_rows"))
    )
    # Both readings of the sizes below share one exchange, so the counters are read once.
    row = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(_order(numeric_order))], version, "total_rows")
    wanted = F.max(row) if latest_version is None else F.max(F.when(version == latest_version, row))
    dated = sizes
    if released is not None and latest_version is None:
        dated = sizes.join(released.select("app_version", "release_date"), "app_version", "left")
        wanted = F.max(F.struct("release_date", row.alias("row")))["row"]
    ends = dated.agg(F.min(row).alias("lowest"), wanted.alias("latest"))
    # The lowest and the latest may be among the largest, so two more are taken.
    largest = sizes.orderBy(F.col("total_rows").desc(), version.desc()).limit(others + 2)
    named = {
        "lowest": ends.select(F.lit("lowest").alias("kind"), "lowest.app_version", "lowest.total_rows"),
        "latest": ends.select(F.lit("latest").alias("kind"), "latest.app_version", "latest.total_rows"),
        "large": largest.select(F.lit("large").alias("kind"), "app_version", "total_rows"),
    }
    candidates = named["large"].unionByName(named["lowest"]).unionByName(named["latest"])

    # The windows from here on see others + 4 rows at most.
    def of_kind(kind: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, version)).over(Window.partitionBy())

    lowest = of_kind("lowest") if drop_lowest else F.lit(None).cast("string")
    known = candidates.withColumns({"_lowest": lowest, "_latest": of_kind("latest")})
    is_latest = F.col("kind") == "latest"
    kept = known.where(
        version.isNotNull()
        & (F.col("kind") != "lowest")
        & ~version.eqNullSafe(F.col("_lowest"))
        & (is_latest | ~version.eqNullSafe(F.col("_latest")))
    )
    by_size = Window.orderBy(is_latest.desc(), F.col("total_rows").desc(), version.desc())
    chosen = kept.withColumn("_pick", F.row_number().over(by_size)).where(
        is_latest | (F.col("_pick") <= F.when(F.col("_latest").isNull(), others).otherwise(others + 1))
    )
    position = F.row_number().over(Window.orderBy(*[c.desc() for c in _order(numeric_order)])) - F.lit(1)
    return chosen.select(
        "app_version", "total_rows", F.concat(F.lit("app_latest_"), position.cast("string")).alias("row_number")
    )


def release_date_first_seen(history: DataFrame, current: DataFrame, versions: DataFrame) -> DataFrame:
    """First event date of each listed version over both tables, with a display label.

    ``versions``, a dozen at most, is read at once, so that its list is part of both scans: pass it staged.
    """
    seen = history.select("app_version", "event_date").unionByName(current.select("app_version", "event_date"))
    first = (
        rows_of_listed(seen, "app_version", versions)
        .groupBy("app_version")
        .agg(F.min(F.to_date("event_date")).alias("release_date"))
    )
    date_text = F.date_format("release_date", "yyyy-MM-dd")
    label = F.concat("app_version", F.lit(" (Release date- "), date_text, F.lit(")"))
    return first.withColumn("app_version_1", label)


def version_tagging(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """Platform rows with the label of their version; unlisted versions have none.

    ``labels`` has at most a dozen rows, so Spark broadcasts it by its own size check.
    """
    return platform_rows(counts).join(labels.select("app_version", "row_number"), "app_version", "left")
