"""Audit outputs: summary per version, issue list, breach flags."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetry.functions.rows import pick_first
from haulmetry.operators.event_quality import COUNTERS, MEASURES, OVERALL_FLAG

# Measures the summary leaves out or marks optional, and what it must show.
SUMMARY_LEFT_OUT = ("entity_lower", "miscellaneous_lower")
SUMMARY_OPTIONAL = ("demand_id_fill", "entity_fill")
# Measures whose share below 99 percent is a breach.
MANDATORY = (
    "event_name_lower",
    "event_action_fill",
    "event_action_lower",
    "event_action_format",
    "event_category_lower",
    "screen_name_fill",
    "screen_name_lower",
    "user_code_fill",
    "user_code_logout",
    "demand_id_int",
    "event_platform_fill",
    "target_product_fill",
    "entity_key",
    "miscellaneous_key",
)
BREACH_BELOW = 99.0

ISSUE_KEYS = (
    "target_product",
    "event_platform",
    "row_number",
    "event_name",
    "event_action",
    "event_category",
    "screen_name",
)
ISSUE_SIGNATURE = ("event_name", "event_action", "event_category", "screen_name")
EXPORT_COLUMNS = (
    "app_version",
    "event_name",
    "event_action",
    "event_category",
    "screen_name",
    "target_product",
    "issue_type",
)


def summary_long(rates: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per version and metric: ``app_version``, ``measure``, ``key_name``, ``metrics``, ``value``.

    ``labels`` maps ``row_number`` to ``app_version`` and its display label ``app_version_1``. The join
    is on the version's own label, so a row can never carry another version's name; a version that
    was never released is shown by its number.
    """
    shown = [m for m in MEASURES if m[0] not in SUMMARY_LEFT_OUT]
    named = rates.join(
        labels.select(F.col("row_number").alias("flag"), F.coalesce("app_version_1", "app_version").alias("app_version_1")),
        "flag",
        "left",
    ).withColumn("app_version", F.when(F.col("flag") == OVERALL_FLAG, F.lit("overall")).otherwise(F.col("app_version_1")))
    values = named.select(
        "app_version",
        F.col("total_events").cast("double").alias("total_events"),
        *[F.col(f"{name}_pct").alias(name) for name, _, _ in shown],
    )
    long = values.unpivot(["app_version"], ["total_events", *[m[0] for m in shown]], "measure", "value")
    key_names, metrics = {"total_events": "total_events"}, {"total_events": "--"}
    for name, key, metric in shown:
        key_names[name] = key
        metrics[name] = f"{metric}_pct" + ("_optional" if name in SUMMARY_OPTIONAL else "")
    return long.select(
        "app_version",
        "measure",
        _lookup("measure", key_names).alias("key_name"),
        _lookup("measure", metrics).alias("metrics"),
        "value",
    )


def _lookup(column: str, values: dict[str, str]) -> Column:
    pairs = [F.lit(item) for pair in values.items() for item in pair]
    return F.element_at(F.create_map(*pairs), F.col(column))


def summary_by_version(long: DataFrame, versions: Iterable[str] | None = None) -> DataFrame:
    """Metric rows with one column per version.

    ``long`` holds at most a dozen versions; pass their names to spare Spark the look-up job.
    """
    grouped = long.groupBy("key_name", "metrics")
    pivoted = grouped.pivot("app_version", list(versions)) if versions is not None else grouped.pivot("app_version")
    return pivoted.agg(F.first("value", ignorenulls=True))


def breach_flag(long: DataFrame, mandatory: Iterable[str] = MANDATORY, below: float = BREACH_BELOW) -> DataFrame:
    """Mark the mandatory shares that are under the limit."""
    return long.withColumn(
        "breach", F.coalesce(F.col("measure").isin(*mandatory) & (F.col("value") < below), F.lit(False))
    )


def _issue_rules() -> list[Column]:
    """Issue phrases in report order, from whole-percent shares."""

    def share(name: str) -> Column:
        return F.col(f"{name}_pct")

    # Phrases and cut-offs.
    rules = (
        (share("event_name_lower") < 99, "event name not in lower case"),
        (
            (share("event_action_fill") < 99) | (share("event_action_lower") < 99) | (share("event_action_format") < 99),
            "issue in event_action",
        ),
        (
            (share("event_category_fill") >= 99) & (share("event_category_lower") < 99),
            "event category not in lower case",
        ),
        (share("screen_name_fill") < 99, "screen name missing"),
        ((share("screen_name_fill") >= 99) & (share("screen_name_lower") < 99), "screen name not in lower case"),
        ((share("entity_fill") >= 90) & (share("entity_key") < 95), "entity key value is not in right format"),
        (
            (share("miscellaneous_fill") >= 95) & (share("miscellaneous_key") < 95),
            "miscellaneous key value is not in right format",
        ),
        (share("user_code_fill") < 80, "user_code missing"),
        ((share("demand_id_fill") >= 95) & (share("demand_id_int") < 95), "demand id not in numeric"),
        (share("event_platform_fill") < 99, "event_platform missing"),
        (share("event_platform_lower") < 99, "event_platform not in lower case"),
        (share("target_product_fill") < 99, "target product missing"),
        (share("target_product_lower") < 99, "target product not in lower case"),
    )
    return [F.when(condition, F.lit(phrase)) for condition, phrase in rules]


def issue_classifier(tagged: DataFrame, drop_null_keys: bool = True) -> DataFrame:
    """Shares per product, platform, version and event spelling, and the issues they reveal.

    ``drop_null_keys`` leaves out groups with a missing key, as the audit does; without it the
    rules about missing screens and products can fire too.
    """
    rows = tagged.dropna(subset=list(ISSUE_KEYS)) if drop_null_keys else tagged
    audited = [name for name in COUNTERS if name != "device_id_fill"]
    sums = rows.groupBy(*ISSUE_KEYS).agg(
        F.sum("total_rows").cast("bigint").alias("total_rows"),
        *[F.sum(name).cast("bigint").alias(name) for name in audited],
    )
    total = F.col("total_rows")
    shares = sums.withColumns(
        {f"{name}_pct": F.round(F.col(name) / total * F.lit(100.0), 1).cast("int") for name in audited}
    )
    return shares.withColumn("issue_type", F.concat_ws(",", *_issue_rules()))


def issue_latest_version(issues: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per event spelling with an issue, from the newest labelled version that shows it."""
    position = F.element_at(F.split("row_number", "_"), -1).cast("int")
    payload = ("row_number", "target_product", "event_platform", "issue_type")
    # The condition sits in the aggregate: as a filter it would be rewritten through all the
    # share columns it depends on, which makes planning very slow.
    found = F.col("issue_type") != ""
    newest = issues.groupBy(*ISSUE_SIGNATURE).agg(pick_first(position, *payload, when=found).alias("_row"))
    picked = newest.where(F.col("_row").isNotNull()).select(*ISSUE_SIGNATURE, *[F.col(f"_row.{name}").alias(name) for name in payload])
    return picked.join(labels.select("row_number", "app_version"), "row_number", "left").select(
        "target_product", "app_version", *ISSUE_SIGNATURE, "issue_type"
    )


def issue_export(latest: DataFrame) -> DataFrame:
    """Distinct issue rows in export order; write them with ``sources.sinks.export_csv``."""
    return latest.select(*EXPORT_COLUMNS).dropDuplicates()
