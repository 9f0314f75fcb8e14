"""Operator payments: trip balance, and how fast advances and balances are paid."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetry.functions.clock import boundary_diff, local_from_epoch, to_local
from haulmetry.functions.ratio import percent
from haulmetry.functions.rows import earliest_per_key, latest_time
from haulmetry.functions.text import json_document, json_field, number
from haulmetry.operators.exclusions import (
    TEST_NAMES,
    full_load_demands,
    real_consigners,
    without_cancelled_comments,
    without_partial_comments,
)

# Ledger codes, bucket names and limits in minutes, settled balance, report start.
PARTY = "OPERATOR"
PAID_STATUSES = ("SUCCESS", "DONE")
LATENCY_BUCKETS = ("LessThan6Hr", "Btw6to12Hr", "Btw12to24Hr", "Morethan24Hr")
SIX_HOURS, TWELVE_HOURS, ONE_DAY = 360, 720, 1_440
SETTLED_BELOW = 200
PAYMENTS_SINCE = "2023-07-01"
PROOF_VERIFIED, PROOF_VALID = "VERIFIED", "OK"


def _trip_number(code: str) -> Column:
    return F.split_part(F.col(code), F.lit("-"), F.lit(2))


def trip_balance(reports: DataFrame, expenses: DataFrame, bank_payments: DataFrame) -> DataFrame:
    """Freight plus credits less debits, tax and payments, per demand of an ended trip.

    Credits, debits and tax rate default to zero; freight and payments do not, so a trip
    without payments has no balance.
    """
    amount = F.coalesce(F.col("amount"), F.lit(0.0))
    category = F.col("category")
    extras = (
        expenses.where(
            category.isin("CREDIT", "DEBIT") & (F.col("party_type") == PARTY) & (F.col("deleted") == "false")
        )
        .groupBy(F.col("consignment_id").alias("trip_number"))
        .agg(
            F.sum(F.when(category == "CREDIT", amount)).alias("credits"),
            F.sum(F.when(category == "DEBIT", amount)).alias("debits"),
        )
    )
    tax = earliest_per_key(reports, ["demand_id"], "tds_amount", ["tds_value"])
    # Payments are summed per trip before they meet the reports, then per demand.
    paid = (
        bank_payments.where((F.col("otherparty") == PARTY) & F.col("status").isin(*PAID_STATUSES))
        .groupBy(F.col("code").alias("consignment_code"))
        .agg(F.sum(amount).alias("paid"))
        .join(reports.select("demand_id", "consignment_code"), "consignment_code", "inner")
        .groupBy("demand_id")
        .agg(F.sum("paid").alias("oppaid"))
    )
    ended = reports.where(F.col("vehicle_state") == "TRIP_END").select(
        "demand_id", "op_freight", _trip_number("consignment_code").alias("trip_number")
    )
    zero = F.lit(0.0)
    joined = (
        ended.join(extras, "trip_number", "left")
        .join(tax, "demand_id", "left")
        .join(paid, "demand_id", "left")
        .withColumns(
            {
                "opadd": F.coalesce("credits", zero),
                "opsub": F.coalesce("debits", zero),
                "tv": F.coalesce(number(F.col("tds_value")), zero),
            }
        )
        .withColumn("tds", F.col("op_freight") * F.col("tv"))
    )
    balance = F.col("op_freight") + F.col("opadd") - F.col("opsub") - F.col("tds") - F.col("oppaid")
    return joined.select(
        "demand_id", "op_freight", "opadd", "opsub", "tv", "tds", "oppaid", balance.alias("trip_bal")
    ).distinct()


def latency_bucket(minutes: Column, settled: Column) -> Column:
    """Bucket of a payment delay; a trip that needed no payment counts as fastest."""
    fastest, half_day, day, slow = (F.lit(name) for name in LATENCY_BUCKETS)
    return (
        F.when(minutes < SIX_HOURS, fastest)
        .when(minutes.between(SIX_HOURS, TWELVE_HOURS), half_day)
        .when(minutes.between(TWELVE_HOURS, ONE_DAY), day)
        .when(minutes > ONE_DAY, slow)
        .when(settled, fastest)
    )


def _little_left() -> Column:
    return F.coalesce(F.col("trip_bal") < SETTLED_BELOW, F.lit(True))


def reported_trips(
    consignments: DataFrame,
    reports: DataFrame,
    demands: DataFrame,
    consigners: DataFrame,
    comments: DataFrame,
    partial_patterns: Iterable[str],
    since: str = PAYMENTS_SINCE,
    test_names: Iterable[str] = TEST_NAMES,
) -> DataFrame:
    """Ended trips with their report, after the exclusions both latency reports share."""
    named = real_consigners(consigners, test_names).select(F.col("code").alias("consigner_code"))
    full_loads = full_load_demands(demands).select(F.col("id").alias("demand_id"))
    kept = (
        reports.where(F.col("unloading_done_time") >= F.lit(since).cast("timestamp_ntz"))
        .select("demand_id", "consigner_code", "unloading_done_time", "trip_start_time")
        .join(named, "consigner_code", "left_semi")
        .join(full_loads, "demand_id", "left_semi")
        .select("demand_id", "unloading_done_time", "trip_start_time")
        .distinct()  # the reports below are over distinct rows; here they are fewer
    )
    kept = without_partial_comments(without_cancelled_comments(kept, comments), comments, partial_patterns)
    ended = consignments.where((F.col("deleted") == "false") & (F.col("state") == "TRIP_END"))
    return ended.select("demand_id", "code", "offline_metadata").join(kept, "demand_id", "inner")


def _daily(rows: DataFrame, paid: str, extra: dict[str, Column] | None = None) -> DataFrame:
    bucket = F.col("time_dispose")
    extra = extra or {}
    per_trip = rows.groupBy(F.to_date("unloading_done_time").alias("month"), "code").agg(
        F.count(bucket).alias(paid),
        *[F.count_if(bucket == name).alias(name) for name in LATENCY_BUCKETS],
        *[count.alias(name) for name, count in extra.items()],
    )
    counted = (paid, *LATENCY_BUCKETS, *extra)
    daily = per_trip.groupBy("month").agg(
        F.count("code").alias("total_trips"), *[F.sum(name).cast("bigint").alias(name) for name in counted]
    )
    shares = {f"{name}_prct": percent(F.col(name), F.col(paid), 2) for name in LATENCY_BUCKETS}
    return daily.withColumns(shares)


def advance_latency_daily(trips: DataFrame, transactions: DataFrame, balance: DataFrame) -> DataFrame:
    """Daily buckets of minutes from trip start to the latest advance, from ``reported_trips``."""
    advances = transactions.where(
        (F.col("type") == "ADVANCE")
        & (F.col("status") == "SUCCESS")
        & (F.col("category") == "DEBIT")
        & (F.col("deleted") == "false")
    )
    # The day's counts need the time of the latest advance only: one row per trip, whatever its amount.
    latest = advances.groupBy(F.col("consignment_id").alias("trip_number")).agg(
        to_local(latest_time(F.col("updated"))).alias("pay_time")
    )
    minutes = boundary_diff("minute", F.col("trip_start_time"), F.col("pay_time"))
    rows = (
        trips.withColumn("trip_number", _trip_number("code"))
        .join(latest, "trip_number", "left")
        .join(balance.select("demand_id", "trip_bal").distinct(), "demand_id", "left")
        .withColumn("time_diff", minutes)
        .withColumn("time_dispose", latency_bucket(F.col("time_diff"), _little_left() & F.col("time_diff").isNull()))
    )
    distinct = rows.select(
        "code",
        "demand_id",
        "unloading_done_time",
        "pay_time",
        "time_diff",
        "time_dispose",
        "trip_bal",
    ).distinct()
    return _daily(distinct, "advance_paid")


def balance_latency_daily(trips: DataFrame, bank_payments: DataFrame, balance: DataFrame) -> DataFrame:
    """Daily buckets of minutes from the later of unloading and proof entry to the latest balance payment.

    Only trips whose proof of delivery is verified and valid count.
    """
    settled = bank_payments.where((F.col("opsremarks") == "BALANCE") & (F.col("status") == "SUCCESS"))
    latest = settled.groupBy("code").agg(to_local(latest_time(F.col("actpaidtime"))).alias("pay_time"))
    proof = json_document(F.col("offline_metadata"), "podStatus string, podValidity string, podCollectedDate string")
    collected = number(json_field(F.col("proof"), "podCollectedDate"))
    proven = (
        # The parsed document goes through a generator, so filters below don't parse it again.
        trips.withColumn("proof", F.explode(F.array(proof)))
        .select(
            "code",
            "demand_id",
            "unloading_done_time",
            json_field(F.col("proof"), "podStatus").alias("pod_status"),
            json_field(F.col("proof"), "podValidity").alias("pod_validity"),
            F.when(collected > 0, local_from_epoch(collected)).alias("pod_entry_time"),
        )
        .where((F.col("pod_status") == PROOF_VERIFIED) & (F.col("pod_validity") == PROOF_VALID))
    )
    unloaded, entered = F.col("unloading_done_time"), F.col("pod_entry_time")
    # NULL when either side is missing, unlike greatest().
    due = F.when(unloaded >= entered, unloaded).when(entered >= unloaded, entered)
    rows = (
        proven.join(latest, "code", "left")
        .join(balance.select("demand_id", "trip_bal").distinct(), "demand_id", "left")
        .withColumn("time_diff", boundary_diff("minute", due, F.col("pay_time")))
        .withColumn("time_dispose", latency_bucket(F.col("time_diff"), _little_left() & F.col("pay_time").isNull()))
    )
    distinct = rows.select(
        "code",
        "demand_id",
        "unloading_done_time",
        "pay_time",
        "pod_status",
        "pod_entry_time",
        "time_diff",
        "time_dispose",
        "trip_bal",
    ).distinct()
    return _daily(distinct, "balance_paid", {"verified": F.count_if(F.col("pod_status") == PROOF_VERIFIED)})
