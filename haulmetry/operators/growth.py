"""Operator growth: subscriptions, quotes, the acquisition funnel, and calls per trip."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmetry.functions.clock import calendar_labels, period, to_local
from haulmetry.functions.ratio import ratio
from haulmetry.functions.text import json_text, number
from haulmetry.operators.exclusions import full_load_demands

# Profile status, active days, report starts, and the calls that count.
VERIFIED = "VERIFIED"
ACTIVE_DAYS = 30
QUOTES_SINCE = "2023-01-01"
CALLS_SINCE = "2023-07-13"
CALL_PRODUCT = "Marketplace"
CALLER_TYPE = "Customer"
CALL_DISPOSITIONS = (
    "MP_VEHICLE OVERLOAD / OVERHEIGHT ISSUE",
    "MP_TRACKING ISSUE",
    "MP_DEMAND CANCEL FROM SHIPPER",
    "MP_TICKET UNRESOLVED",
    "MP_TOKEN MONEY QUERY",
    "MP_TRIP UPDATE ISSUE",
    "MP_VEHICLE CANCELLATION CHARGES",
    "MP_VEHICLE NO / DRIVER NO CHANGE",
    "MP_VEHICLE REPLACEMENT STATUS",
    "MP_EXTRA DISTANCE CHARGES",
    "MP_ADVANCE QUERY",
    "MP_TOKEN MONEY REFUND QUERY",
    "MP_TRANSIT HAULTIING CHARGE",
    "MP_VEHICLE BREAKDOWN",
    "MP_LOADING TIME POSTPONED",
    "MP_WAITING FOR LOADING / UNLOADING",
    "MP_LOADING / UNLOADING CHARGE",
    "MP_TICKET RESOLVED",
    "MP_DAMAGE / SHORTAGE",
    "MP_TRANSIT DELAY PENALTY",
    "MP_WAITING FOR BILTY / POD",
    "MP_LOADING/ UNLOADING/ POC ADDRESS QUERY",
    "MP_MULTIPLE LOADING / UNLOADING POINT",
    "MP_LOADING / UNLOADING DETENTION",
    "MP_GTL DELAY PENALTY QUERY",
    "MP_PAYMENT DONE UTR NOT GENERATED",
)
FUNNEL = ("op_subscribed", "op_verified", "op_profile_completed", "op_active_quote", "op_active_placement")


def _running(order: str):
    # Callers order one row per calendar period, so this window holds a few thousand rows at most.
    return Window.orderBy(F.col(order).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def subscriptions_cumulative(subscriptions: DataFrame) -> DataFrame:
    """Running total of the daily distinct subscribers, with calendar labels."""
    daily = (
        subscriptions.where(F.col("deleted") == "false")
        .groupBy(F.to_date("created_at").alias("s_date"))
        .agg(F.count_distinct("user_code").alias("sub_op"))
    )
    totals = daily.withColumn("cumulative_subscribed", F.sum("sub_op").over(_running("s_date")))
    return calendar_labels(totals.drop("sub_op"), "s_date")


def positive_quotes(quotations: DataFrame) -> DataFrame:
    """Quotations with a quoted amount above zero."""
    return quotations.where(number(json_text(F.col("app_response_details"), "quote")) > 0)


def quotes_per_operator_daily(quotations: DataFrame, since: str = QUOTES_SINCE) -> DataFrame:
    """Demands quoted per operator and day, counting each operator and demand once a day."""
    quoted = (
        positive_quotes(quotations)
        .select("operator_code", F.to_date("created").alias("quote_date"), "demand_id")
        .where(F.col("quote_date") >= F.lit(since).cast("date"))
        .dropDuplicates()
    )
    per_operator = quoted.groupBy("quote_date", "operator_code").agg(F.count("demand_id").alias("demands"))
    daily = per_operator.groupBy("quote_date").agg(
        F.sum("demands").cast("bigint").alias("demands"), F.count("operator_code").alias("operators")
    )
    return daily.withColumn("quotes_per_op", ratio(F.col("demands"), F.col("operators")))


def acquisition_base(
    subscriptions: DataFrame,
    quotations: DataFrame,
    consignments: DataFrame,
    profiles: DataFrame,
    rate_inputs: DataFrame,
    as_of: dt.date,
    active_days: int = ACTIVE_DAYS,
) -> DataFrame:
    """One row per subscription with its funnel flags; shared by the daily, weekly and monthly funnels."""
    live = F.col("deleted") == "false"

    def last_day(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col("operator_code").alias("user_code")).agg(F.max(F.to_date("created")).alias(name))

    quoted = last_day(positive_quotes(quotations), "latest_quote")
    placed = last_day(consignments.where(live & (F.col("state") != "CANCELLED")), "latest_placement")
    verified = profiles.where(live).select("user_code", "kyc_status")
    rated = (
        rate_inputs.where(F.col("active") == "true")
        .groupBy("user_code")
        .agg(F.count(F.when(F.col("rate") > 0, F.col("user_code"))).alias("q_count"))
    )
    today = F.lit(as_of).cast("date")

    def recent(day: str):
        return F.coalesce(F.date_diff(today, F.col(day)) <= active_days, F.lit(False))

    joined = subscriptions.where(live).select("user_code", "created_at")
    for side in (quoted, placed, verified, rated):
        joined = joined.join(side, "user_code", "left")
    known = F.col("user_code").isNotNull()
    return joined.select(
        "created_at",
        known.alias("op_subscribed"),
        (known & F.coalesce(F.col("kyc_status") == VERIFIED, F.lit(False))).alias("op_verified"),
        (known & F.coalesce(F.col("q_count") > 0, F.lit(False))).alias("op_profile_completed"),
        (known & recent("latest_quote")).alias("op_active_quote"),
        (known & recent("latest_placement")).alias("op_active_placement"),
    )


def acquisition_funnel(base: DataFrame, grain: str) -> DataFrame:
    """Running totals of the five funnel counts per day, week or month."""
    start = {"day": "subs_date", "week": "subs_week", "month": "subs_month"}[grain]
    counts = base.groupBy(period(F.col("created_at"), grain).alias(start)).agg(
        *[F.count_if(F.col(name)).alias(name) for name in FUNNEL]
    )
    return counts.select(start, *[F.sum(name).over(_running(start)).alias(f"{name}_") for name in FUNNEL])


def calls_per_trip_daily(
    consignments: DataFrame,
    demands: DataFrame,
    call_records: DataFrame,
    call_crm: DataFrame,
    dispositions: Iterable[str] = CALL_DISPOSITIONS,
    since: str = CALLS_SINCE,
) -> DataFrame:
    """Daily trips, distinct customer calls with a listed disposition, and their ratio."""
    matching = call_crm.where(
        (F.col("c_type") == CALLER_TYPE) & F.col("disposition_code").isin(*dispositions)
    ).select("call_id")
    called = F.to_date("call_time")
    calls = (
        call_records.where((F.col("product") == CALL_PRODUCT) & (called >= F.lit(since).cast("date")))
        .join(matching, "call_id", "left_semi")
        .groupBy(called.alias("day"))
        .agg(F.count_distinct("call_id").alias("calls_count"))
    )
    full_loads = full_load_demands(demands).select(F.col("id").alias("demand_id"))
    trips = (
        consignments.join(full_loads, "demand_id", "left_semi")
        .groupBy(F.to_date(to_local(F.col("created"))).alias("day"))
        .agg(F.count("code").alias("trips"))
    )
    return trips.join(calls, "day", "left").select(
        "day", "trips", "calls_count", ratio(F.col("calls_count"), F.col("trips")).alias("calls_trips_ratio")
    )
