"""Cancelled placements: who caused them, when, and in which order."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetry.functions.clock import boundary_diff, calendar_labels, local_from_epoch, to_local
from haulmetry.functions.codes import owner_of_first, with_owner
from haulmetry.functions.rows import dealt_in_order, fanout_left_join, ordinal_within
from haulmetry.operators.exclusions import (
    CANCELLATION_TEST_NAMES,
    SMALL_BUSINESS,
    full_load_demands,
    real_consigners,
)
from haulmetry.operators.milestones import TRIPS_SINCE

# Cancellation codes and the party each is charged to, first match wins. A code is
# looked for anywhere in the remark, in any case; its underscores match any one character.
CANCEL_RULES = (
    ("CANCELLED_FROM_SHIPPER_DEMAND_EXPIRY", "Consigner"),
    ("CONSIGNER_ASKED_TO_CANCEL_CONSIGNMENT_CANCELLATION", "Consigner"),
    ("VEH_BREAKDOWN_CANCELLED_BY_OPERATOR", "Operator"),
    ("OP_DENIED_FREIGHT_CANCELLED_BY_OPERATOR", "Operator"),
    ("KYC_ISSUE_CONSIGNMENT_CANCELLATION", "Kyc"),
    ("VEHICLE_GETTING_DELAYED_CANCELLED_BY_CONSIGNER_V2", "Operator"),
    ("LOADING_POSTPONED_CANCELLED_BY_CONSIGNER_V2", "Consigner"),
    ("LOADING_POSTPONED_CONSIGNMENT_CANCELLATION", "Consigner"),
    ("POSTPONED_BY_SHIPPER_DEMAND_EXPIRY", "Consigner"),
    ("DRIVER_DENIED_CANCELLED_BY_CONSIGNER_V2", "Operator"),
    ("ADDRESS_CHANGE_CONSIGNMENT_CANCELLATION", "Consigner"),
    ("FOUND_VEHICLE_AT_BETTER_PRICE_CANCELLED_BY_CONSIGNER_V2", "Consigner"),
    ("VEHICLE_NOT_EMPTY_CANCELLED_BY_OPERATOR", "Operator"),
    ("DRIVER_DENIED_CONSIGNMENT_CANCELLATION", "Operator"),
    ("TECH_ISSUE_CONSIGNMENT_CANCELLATION", "Tech"),
    ("BLACKLISTED_OPERATOR_CONSIGNMENT_CANCELLATION", "Operator"),
    ("DELAYED_ARRIVAL_CONSIGNMENT_CANCELLATION", "Operator"),
    ("TONNAGE_HEIGHT_CHANGE_CONSIGNMENT_CANCELLATION", "Consigner"),
    ("OTHER_DEMAND_EXPIRY", "Other"),
    ("NO_RESPONSE_FROM_CUSTOMER_CONSIGNMENT_CANCELLATION", "Consigner"),
    ("ALTERNATIVE_LOAD_CONSIGNMENT_CANCELLATION", "Operator"),
    ("DRIVER_DENIED_CANCELLED_BY_OPERATOR", "Operator"),
    ("REPEATED_INDENT_DEMAND_EXPIRY", "Other"),
    ("PLACED_BY_MISTAKE_CONSIGNMENT_CANCELLATION", "Other"),
    ("GPS_NOT_AVAILABLE_CONSIGNMENT_CANCELLATION", "Operator"),
    ("GPS_NOT_AVAILABLE_CANCELLED_BY_OPERATOR", "Operator"),
    ("MATERIAL_TYPE_DIFFERENT_CONSIGNMENT_CANCELLATION", "Consigner"),
    ("VEHICLE_AT_UNLOADING_CONSIGNMENT_CANCELLATION", "Operator"),
    ("OP_DENIED_FREIGHT_CONSIGNMENT_CANCELLATION", "Operator"),
    ("VEH_BREAKDOWN_CONSIGNMENT_CANCELLATION", "Operator"),
    ("OVERLOAD_OVERHEIGHT_ISSUE_DEMAND_EXPIRY", "Consigner"),
    ("CONSIGNEE_BOOKED_VEHICLE_DEMAND_EXPIRY", "Consigner"),
    ("VEHICLE_NOT_EMPTY_CONSIGNMENT_CANCELLATION", "Operator"),
    ("RFQ_DEMAND_EXPIRY", "Other"),
    ("CREDIT_CYCLE_ISSUE_DEMAND_EXPIRY", "Consigner"),
    ("CANCELLED_AFTER_FULFILMENT_TRANSPORTER_DEMAND_EXPIRY", "Consigner"),
    ("OTHERS_CONSIGNMENT_CANCELLATION", "Other"),
    ("CANCELLED_AFTER_FULFILMENT_DEMAND_DEMAND_EXPIRY", "Consigner"),
    ("LESS_PLACEMENT_TIME_DEMAND_EXPIRY", "Other"),
    ("LACK_OF_MATERIAL_WITH_TRANSPORTER_DEMAND_EXPIRY", "Consigner"),
    ("BOOKED_ANOTHER_VECHICLE_DEMAND_EXPIRY", "Consigner"),
    ("MATERIAL_NOT_READY_DEMAND_EXPIRY", "Consigner"),
    ("ALTERNATIVE_LOAD_CANCELLED_BY_OPERATOR", "Operator"),
    ("DELAYED_COMMUNICATION_DEMAND_EXPIRY", "Other"),
    ("VIA_POINT_ADDED_CONSIGNMENT_CANCELLATION", "Consigner"),
    ("DATA_ENTRY_MISTAKE_DEMAND_EXPIRY", "Other"),
    ("OPERATOR_BACKOUT_DEMAND_EXPIRY", "Operator"),
    ("UNFIT_VEHICLE_DEMAND_EXPIRY", "Operator"),
    ("PRICE_FOR_KNOWN_LANES_NOT_FOUND_DEMAND_EXPIRY", "Other"),
    ("ADDRESS_MISMATCH_DEMAND_EXPIRY", "Consigner"),
    ("VEHICLE_NOT_FOUND_DEMAND_EXPIRY", "Other"),
    ("VEHICLE_SIZE_TYPE_MISMATCH_DEMAND_EXPIRY", "Operator"),
    ("CANCELLED_AFTER_FULFILMENT_CONSIGNEE_DEMAND_EXPIRY", "Consigner"),
    ("NO_ENTRY_SLOT_CONSIGNMENT_CANCELLATION", "Operator"),
    ("LOADING_POSTPONED_CANCELLED_BY_CONSIGNER_WITHOUT_CONSIGNMENT", "Consigner"),
    ("DEMAND_MODIFIED_CONSIGNOR_APP", "Consigner"),
    ("FOUND_VEHICLE_AT_BETTER_PRICE_CANCELLED_BY_CONSIGNER_WITHOUT_CONSIGNMENT", "Consigner"),
    ("INCORRECT_UNLOADING_LOCATION_DEMAND_EXPIRY", "Consigner"),
    ("BREAKDOWN_WITH_VERIFICATION_CONSIGNMENT_CANCELLATION", "Operator"),
    ("VEHICLE_GETTING_DELAYED_CANCELLED_BY_CONSIGNER_AT_GTL", "Operator"),
    ("OPERATOR_DENIED_OR_NOT_RESPONDING_CANCELLED_BY_CONSIGNER_AT_GTL", "Operator"),
    ("LOADING_POSTPONED_CANCELLED_BY_CONSIGNER_AT_GTL", "Consigner"),
    ("BOOKED_ANOTHER_VEHICLE_CANCELLED_BY_CONSIGNER_AT_GTL", "Consigner"),
    ("LOADING_POSTPONED_CANCELLED_BY_CONSIGNER_AT_LOADING", "Consigner"),
    ("FOUND_VEHICLE_AT_BETTER_PRICE_CANCELLED_BY_CONSIGNER_AT_GTL", "Consigner"),
    ("FOUND_VEHICLE_AT_BETTER_PRICE_CANCELLED_BY_CONSIGNER_AT_LOADING", "Consigner"),
    ("BOOKING_REQUIREMENT_CHANGE_CANCELLED_BY_CONSIGNER_AT_GTL", "Consigner"),
    ("DELAYED_COMMUNICATION_DEMAND_DEMAND_EXPIRY", "Other"),
    ("UNFIT_VEHICLE_CONSIGNMENT_CANCELLATION", "Operator"),
    ("SR_NA_OVERHEIGHT_CONSIGNMENT_CANCELLATION", "Operator"),
    ("SR_NA_OVERWEIGHT_CONSIGNMENT_CANCELLATION", "Operator"),
    ("SR_NA_EXP_DELIVERY_CONSIGNMENT_CANCELLATION", "Operator"),
    ("SR_NA_DIESEL_VEH_CONSIGNMENT_CANCELLATION", "Operator"),
    ("SR_NA_OPEN_DALA_CONSIGNMENT_CANCELLATION", "Operator"),
    ("VEH_MISMATCH_SIZE_DIFFERENT_CONSIGNMENT_CANCELLATION", "Operator"),
    ("VEH_MISMATCH_BODY_DIFFERENT_CONSIGNMENT_CANCELLATION", "Operator"),
    ("BOOKING_REQUIREMENT_CHANGE_CANCELLED_BY_CONSIGNER_AT_LOADING", "Consigner"),
    ("BOOKED_ANOTHER_VEHICLE_CANCELLED_BY_CONSIGNER_AT_LOADING", "Consigner"),
    ("BOOKING_REQUIREMENT_CHANGE_CANCELLED_BY_CONSIGNER_AT_LOADING", "Consigner"),
    ("WRONG_VEHICLE_REACHED_CANCELLED_BY_CONSIGNER_AT_LOADING", "Consigner"),
)

# The state numbered within its demand, and tokens that do not count.
CANCELLED = "CANCELLED"
IDLE_TOKENS = ("EXPIRED", "INITIATED")
# Key, order and ties of the ordinal.
ORDINAL = (
    ("demand_id", "consignment_state"),
    "placement_time",
    ("code", "cancel_time", "cancelled_by", "token_status", "cancel_remarks"),
)

REPORT_COLUMNS = (
    "demand_id",
    "code",
    "placement_time",
    "consignment_state",
    "status",
    "placed_cancel_reason",
    "ord",
    "operator_code",
    "week_date",
    "month_year",
    "date",
)


def cancel_reason(remark: Column, rules: Sequence[tuple[str, str]] = CANCEL_RULES) -> Column:
    """Party charged with a cancellation: owner of the first code found in the remark, or NULL."""
    return owner_of_first(remark, rules)


def charged(states: DataFrame, rules: Sequence[tuple[str, str]] = CANCEL_RULES) -> DataFrame:
    """State rows with the party that each one's remark charges; equal remarks are read once."""
    return with_owner(states, "remarks", rules, "placed_cancel_reason")


def cancellation_rows(
    consignments: DataFrame,
    states: DataFrame,
    demands: DataFrame,
    consigners: DataFrame,
    vehicle_types: DataFrame,
    tokens: DataFrame,
    since: str = TRIPS_SINCE,
    test_names: Iterable[str] = CANCELLATION_TEST_NAMES,
    rules: Sequence[tuple[str, str]] = CANCEL_RULES,
) -> DataFrame:
    """Placements of small businesses with their cancellation rows; one row per cancel row and token.

    They are dealt in the order in which ``cancellations_fact`` numbers them: write them first.
    """
    placed = to_local(F.col("created"))
    small = (
        real_consigners(consigners, test_names)
        .where(F.col("type").isin(*SMALL_BUSINESS))
        .select(F.col("code").alias("consigner_user_code"))
    )
    kept = full_load_demands(demands).select(
        F.col("id").alias("demand_id"), "status", "consigner_user_code", "vehicle_type_id"
    )
    tyres = vehicle_types.select(F.col("id").alias("vehicle_type_id"), "tyre_count")
    kept = kept.join(small, "consigner_user_code", "inner").join(tyres, "vehicle_type_id", "left")
    placements = consignments.where(placed >= F.lit(since).cast("timestamp_ntz")).select(
        "code", "demand_id", "operator_code", placed.alias("placement_time"), F.col("state").alias("consignment_state")
    )
    cancels = charged(states.where((F.col("state") == CANCELLED) & (F.col("deleted") == "false")), rules).select(
        F.col("consignment_code").alias("code"),
        "placed_cancel_reason",
        F.col("remarks").alias("cancel_remarks"),
        local_from_epoch(F.col("time")).alias("cancel_time"),
        F.col("updated_by").alias("cancelled_by"),
    )
    live_tokens = tokens.where(~F.col("status").isin(*IDLE_TOKENS)).select(
        "demand_id", "operator_code", F.col("status").alias("token_status")
    )
    rows = placements.join(kept, "demand_id", "inner")
    rows = fanout_left_join(rows, cancels, ["code"], identical_rows=True)
    rows = fanout_left_join(rows, live_tokens, ["demand_id", "operator_code"], identical_rows=True)
    rows = rows.withColumn("cancelled_in", boundary_diff("minute", F.col("placement_time"), F.col("cancel_time")))
    return dealt_in_order(rows, *ORDINAL)


def cancellations_fact(rows: DataFrame) -> DataFrame:
    """Cancellation rows, as written, with the ordinal of cancelled ones and calendar labels.

    ``cancellation_report`` keeps the published columns.
    """
    numbered = ordinal_within(rows, *ORDINAL, "ord")
    shown = numbered.withColumn("ord", F.when(F.col("consignment_state") == CANCELLED, F.col("ord")))
    return calendar_labels(shown, "placement_time", with_date=True)


def cancellation_report(facts: DataFrame) -> DataFrame:
    """The published columns of ``cancellations_fact``."""
    return facts.select(*REPORT_COLUMNS)
