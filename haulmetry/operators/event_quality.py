"""Event parameters, quality counters, and the compliance funnel."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetry.functions.text import key_lookup, text_or_none

# Event names, actions, formats and metric labels of the audit.
EVENT_NAME_PATTERN = "v1_%"
EXCLUDED_EVENTS = (
    "we_notification_dismiss",
    "we_notification_receive",
    "we_notification_foreground",
    "we_notification_open",
    "notification_dismiss",
    "notification_receive",
    "notification_foreground",
    "notification_open",
    "NotificationStatus",
    "user_notification_status",
    "Notificav1_notification_to_apptionAction",
    "mp_token_notification",
    "mp_load_notification_v1",
    "mp_load_notification",
    "bottom_menu_notification",
    "v1_notification_to_app",
    "v1_notification_open",
    "v1_we_notification_open",
    "v1_we_notification_receive",
    "v1_we_notification_foreground",
    "v1_we_notification_dismiss",
    "v1_map_readjust",
    "v1_zoom_in",
    "v1_zoom_out",
    "user_engagement",
    "mp_token_notification_v1",
    "mp_change_freight_notification_v1",
    "v1_success_notification",
    "NotificationAction",
    "notification",
    "v1_perf_native",
    "v1_performance",
    "v1_fcm_token_scheduler_call_success",
    "v1_fcm_token_scheduler_call",
)
EVENT_KEYS = (
    "event_action",
    "event_category",
    "screen_name",
    "entity",
    "miscellaneous",
    "demand_id",
    "event_platform",
    "target_product",
)
DEFINED_ACTIONS = ("click", "view", "scroll", "engagae", "engage", "engagement")
SIGNATURE_ACTIONS = ("click", "api", "view", "engagement", "engage", "scroll", "close", "Click")
ONE_PAIR = r"^\w+:[^:]*$"
MANY_PAIRS = r"^\w+:[^:]+(::\w+:[^:]+)*$"
LOGGED_OUT = "LOGOUT"
# Counter column, key, metric: the label of a measure is "<key> <metric>".
MEASURES = (
    ("event_name_lower", "event_name", "in lower case"),
    ("event_action_fill", "event_action", "fill"),
    ("event_action_lower", "event_action", "in lower case"),
    ("event_action_format", "event_action", "in defined keys"),
    ("event_category_fill", "event_category", "fill"),
    ("event_category_lower", "event_category", "in lower case"),
    ("screen_name_fill", "screen_name", "fill"),
    ("screen_name_lower", "screen_name", "in lower case"),
    ("user_code_fill", "user_code", "fill"),
    ("user_code_logout", "user_code", "LOGOUT"),
    ("demand_id_fill", "demand_id", "fill"),
    ("demand_id_int", "demand_id", "in integer"),
    ("device_id_fill", "device_id", "fill"),
    ("event_platform_fill", "event_platform", "fill"),
    ("event_platform_lower", "event_platform", "in lower case"),
    ("target_product_fill", "target_product", "fill"),
    ("target_product_lower", "target_product", "in lower case"),
    ("entity_fill", "entity", "fill"),
    ("entity_lower", "entity", "in lower case"),
    ("entity_key", "entity", "in right format (key_value)"),
    ("miscellaneous_fill", "miscellaneous", "fill"),
    ("miscellaneous_lower", "miscellaneous", "in lower case"),
    ("miscellaneous_key", "miscellaneous", "in right format (key_value)"),
)

COUNTERS = tuple(name for name, _, _ in MEASURES)
GROUP_KEYS = (
    "event_date",
    "app_info_id",
    "target_product",
    "event_platform",
    "app_version",
    "event_name",
    "event_action",
    "event_category",
    "screen_name",
)
OVERALL_FLAG = "overall"


def event_param_flatten(
    events: DataFrame,
    app_ids: Iterable[str],
    start: str,
    end: str,
    name_pattern: str = EVENT_NAME_PATTERN,
    excluded: Iterable[str] = EXCLUDED_EVENTS,
) -> DataFrame:
    """One column per parameter key, for one app, a range of days and the audited event names."""
    name = F.col("event_name")
    kept = events.where(
        F.col("event_date").between(start, end)
        & F.col("app_info.id").isin(*app_ids)
        & name.like(name_pattern)
        & ~name.isin(*excluded)
    )
    params, properties = F.col("event_params"), F.col("user_properties")
    return kept.select(
        "event_date",
        "event_name",
        *[key_lookup(params, key).alias(key) for key in EVENT_KEYS],
        key_lookup(properties, "user_code").alias("user_code"),
        F.coalesce(key_lookup(properties, "device_id"), key_lookup(properties, "device_Id")).alias("device_id"),
        key_lookup(properties, "op_id").alias("op_id"),
        F.col("app_info.id").alias("app_info_id"),
        F.col("app_info.version").alias("app_version"),
    )


def _is_lower(name: str) -> Column:
    return F.col(name) == F.lower(name)


def _checks() -> dict[str, Column]:
    """The condition each counter counts, for one flattened event."""
    checks = {
        "event_name_lower": _is_lower("event_name"),
        "event_action_format": F.col("event_action").isin(*DEFINED_ACTIONS),
        "entity_key": F.col("entity").rlike(ONE_PAIR),
        "miscellaneous_key": F.col("miscellaneous").rlike(MANY_PAIRS),
        "user_code_fill": F.col("user_code").isNotNull(),
        "user_code_logout": F.col("user_code") == LOGGED_OUT,
        "demand_id_fill": F.col("demand_id").isNotNull(),
        "demand_id_int": F.col("demand_id").try_cast("bigint").isNotNull(),
        "device_id_fill": F.col("device_id").isNotNull(),
        "op_id_fill": F.col("op_id").isNotNull(),
    }
    for key in EVENT_KEYS:
        if key != "demand_id":
            checks[f"{key}_fill"] = F.col(key).isNotNull()
            checks[f"{key}_lower"] = _is_lower(key)
    return checks


def event_quality_counts(flat: DataFrame, *more_keys: str) -> DataFrame:
    """Rows and quality counters per day, product, platform, version and event spelling."""
    checks = _checks()
    return flat.groupBy(*more_keys, *GROUP_KEYS).agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(checks[name]).alias(name) for name in (*COUNTERS, "op_id_fill")],
    )


def event_signature(counts: DataFrame) -> DataFrame:
    """Spell an unknown or missing action ``a`` and join name, action, category and screen into one text."""
    known = F.coalesce(F.col("event_action").isin(*SIGNATURE_ACTIONS), F.lit(False))
    actions = counts.withColumn("event_action", F.when(known, F.col("event_action")).otherwise(F.lit("a")))
    parts = ("event_name", "event_action", "event_category", "screen_name")
    return actions.withColumn("combined_event", F.concat(*[text_or_none(F.col(part)) for part in parts]))


def _sums() -> list[Column]:
    return [F.sum(name).cast("bigint").alias(name) for name in ("total_rows", *COUNTERS)]


def _summed(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(*_sums())


def _with_miss_pct(sums: DataFrame) -> DataFrame:
    total = F.col("total_rows")
    return sums.withColumns(
        {f"{name}_pct": F.round((total - F.col(name)) / total * F.lit(100.0), 1) for name in COUNTERS}
    )


def quality_miss_pct(tagged: DataFrame, by_version: bool = False) -> DataFrame:
    """Share of rows failing each check, per signature, or per signature and labelled version."""
    if by_version:
        labelled = tagged.where(F.col("row_number").isNotNull())
        return _with_miss_pct(_summed(labelled, "combined_event", "row_number"))
    return _with_miss_pct(_summed(tagged, "combined_event"))


def compliance_funnel(tagged: DataFrame) -> DataFrame:
    """Signatures passing each check (under one percent missing): one overall row, one per version."""
    # Both grains come from one pass: each row counts for its signature, and for its signature and version.
    grains = [["combined_event"], ["combined_event", "row_number"]]
    sums = tagged.groupingSets(grains, "combined_event", "row_number").agg(
        F.grouping("row_number").alias("overall"), *_sums()
    )
    miss = _with_miss_pct(sums.where("overall = 1 or row_number is not null"))
    flag = F.when(F.col("overall") == 1, F.lit(OVERALL_FLAG)).otherwise(F.col("row_number")).alias("flag")
    # A signature is one row per group already, so counting rows counts distinct signatures.
    counted = miss.groupBy("overall", flag).agg(
        F.count(F.lit(1)).alias("total_events"),
        *[F.count_if(~F.coalesce(F.col(f"{name}_pct") >= 1, F.lit(False))).alias(name) for name in COUNTERS],
    )
    return counted.drop("overall")


def compliance_rates(funnel: DataFrame) -> DataFrame:
    """Fill measures over all signatures; format measures over their key's fill measure."""
    rates = {}
    for name, key, metric in MEASURES:
        over_all = metric in ("fill", "LOGOUT") or name == "event_name_lower"
        whole = "total_events" if over_all else f"{key}_fill"
        part, total = F.col(name).cast("double"), F.nullif(F.col(whole), F.lit(0))
        rates[f"{name}_pct"] = F.round(part / total * F.lit(100.0), 1)
    return funnel.withColumns(rates)
