"""Damage and shortage: tickets per claim, and daily attribution."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetry.functions.clock import local_from_epoch, to_local
from haulmetry.functions.ratio import ratio
from haulmetry.functions.rows import Keep, as_is
from haulmetry.functions.text import json_document, json_field, json_item
from haulmetry.operators.exclusions import TEST_NAMES, full_load_demands, real_consigners
from haulmetry.operators.milestones import state_epochs
from haulmetry.operators.tickets import APP_SOURCES, ticket_demand

# Subjects of damage tickets, claim types, positions of the item fields, report start.
SUBJECTS = ("%Damage%", "%Shortage%")
APP_SOURCE = "APP"
SHORT, NO_DAMAGE = "SHORT", "NO_DAMAGE"
ITEM_FIELDS = {"items": (0, "name"), "unit": (1, "unit"), "quantity": (2, "quantity")}
CLAIM_FIELDS = "items array<struct<name: string, unit: string, quantity: string>>, proofDocCodes string"
DAMAGE_SINCE = "2024-04-01"

CLAIM_COLUMNS = (
    "claim_status",
    "type",
    "reason",
    "consigner_assessed_amount",
    "assessed_damage_amount",
    "final_closure_amount",
    "items",
    "unit",
    "quantity",
    "proofdoccodes",
)


def damage_tickets(
    tickets: DataFrame,
    fields: DataFrame,
    claims: DataFrame,
    consignments: DataFrame,
    demands: DataFrame,
    consigners: DataFrame,
    portal_source: str,
    damage_assignee: str,
    link_base: str,
    test_names: Iterable[str] = TEST_NAMES,
    keep: Keep = as_is,
) -> DataFrame:
    """One row per claim and ticket month, with its tickets by source and first ticket time.

    ``keep`` is given the tickets, which are read three times.
    """
    live = F.col("deleted") != "true"
    subject = F.col("subject")
    about_damage = (subject.ilike(SUBJECTS[0]) & subject.ilike(SUBJECTS[1])) | (
        F.col("assigned_to") == damage_assignee
    )
    raised = keep(
        tickets.where(live & F.col("source").isin(*APP_SOURCES, portal_source) & about_damage)
        .select(F.col("id").alias("ticket_id"), "ticket_code", "source", to_local(F.col("created")).alias("ticket_creation"))
        .join(ticket_demand(fields), "ticket_id", "inner")
        .where(F.col("tt_dem_id").isNotNull())
        .withColumnRenamed("tt_dem_id", "demand_id")
    )
    link = F.concat(F.lit(link_base), F.col("ticket_code"))
    from_app, from_portal = F.col("source") == APP_SOURCE, F.col("source") == portal_source
    # Tickets are folded to at most twelve months per demand before they meet the claims.
    by_month = raised.groupBy("demand_id", F.month("ticket_creation").alias("ticket_month")).agg(
        F.max(F.when(from_app, F.col("ticket_code"))).alias("app_ticket"),
        F.max(F.when(from_app, link)).alias("app_ticket_link"),
        F.max(F.when(from_portal, link)).alias("portal_ticket_link"),
        F.max(F.when(from_portal, F.col("ticket_code"))).alias("portal_ticket"),
        F.min("ticket_creation").alias("ticket_creation_time"),
    )
    totals = raised.groupBy("demand_id").agg(F.count_distinct("ticket_code").alias("total_tickets"))
    # Only claims of demands with a ticket are parsed.
    trips = (
        consignments.where(live)
        .select("demand_id", F.col("code").alias("trip_id"))
        .join(raised.select("demand_id").distinct(), "demand_id", "left_semi")
        .distinct()
    )
    customers = real_consigners(consigners.where(live), test_names).select("code", "name", "sales_manager").distinct()
    owners = demands.select(F.col("id").alias("demand_id"), F.col("consigner_user_code").alias("code"))
    claimed = (
        claims.where(live)
        .withColumnRenamed("consignment_code", "trip_id")
        .join(trips, "trip_id", "inner")
        # Parsed once: what a generator makes isn't computed again above it.
        .withColumn("_doc", F.explode(F.array(json_document(F.col("metadata"), CLAIM_FIELDS))))
        .withColumns({name: json_item(F.col("_doc"), "items", n, field) for name, (n, field) in ITEM_FIELDS.items()})
        .withColumn("proofdoccodes", json_field(F.col("_doc"), "proofDocCodes"))
        .select("demand_id", "trip_id", *CLAIM_COLUMNS)
        .distinct()
        .join(owners, "demand_id", "inner")
        .join(customers, "code", "inner")
    )
    return (
        claimed.join(by_month, "demand_id", "inner")
        .join(totals, "demand_id", "inner")
        .select(
            "code",
            "name",
            "sales_manager",
            "demand_id",
            "trip_id",
            "ticket_month",
            *CLAIM_COLUMNS,
            "total_tickets",
            (F.col("total_tickets") > 1).cast("int").alias("multiple_ticket_cat"),
            "app_ticket",
            "app_ticket_link",
            "portal_ticket_link",
            "portal_ticket",
            "ticket_creation_time",
        )
    )


def damage_daily(
    consignments: DataFrame, demands: DataFrame, states: DataFrame, damage: DataFrame, since: str = DAMAGE_SINCE
) -> DataFrame:
    """Daily completed trips and how their damage reports were resolved."""
    ended = state_epochs(states, ("TRIP_END",)).select(
        "code", local_from_epoch(F.col("trip_end_epoch")).alias("trip_end_time")
    )
    done = full_load_demands(demands.where(F.col("status") == "FULFILLED")).select(F.col("id").alias("demand_id"))
    trips = (
        consignments.where(F.col("code").isNotNull())
        .select("code", "demand_id")
        .join(ended.where(F.col("trip_end_time") >= F.lit(since).cast("timestamp_ntz")), "code", "inner")
        .join(done, "demand_id", "left_semi")
        .select("code", F.to_date("trip_end_time").alias("daily_trip"))
        .distinct()
    )
    kind = F.col("type")
    # One row of flags per trip, so each distinct count below is a plain count.
    outcomes = (
        damage.where(F.col("total_tickets") >= 1)
        .groupBy(F.col("trip_id").alias("code"))
        .agg(
            F.max(kind.isNull()).alias("open"),
            F.max(kind.isNotNull()).alias("known"),
            F.max(F.coalesce(kind == SHORT, F.lit(False))).alias("short"),
            F.max(F.coalesce(kind == NO_DAMAGE, F.lit(False))).alias("unharmed"),
        )
    )
    daily = (
        trips.join(outcomes, "code", "left")
        .groupBy("daily_trip")
        .agg(
            F.count("code").alias("total_trips"),
            F.count("open").alias("reported"),
            F.count_if("open").alias("not_identfied"),
            F.count_if("known").alias("identfied"),
            F.count_if("short").alias("shortage"),
            F.count_if("unharmed").alias("no_dmg"),
        )
        .withColumn("actual_damage", F.col("identfied") - F.col("no_dmg"))
    )
    whole = F.col("total_trips")
    return daily.withColumns(
        {
            "reported_dmg_share": ratio(F.col("reported"), whole),
            "identfied_dmg_share": ratio(F.col("identfied"), whole),
            "pending_identification_share": ratio(F.col("not_identfied"), whole),
            "no_dmg_found_share": ratio(F.col("no_dmg"), whole),
            "actual_dmg_share": ratio(F.col("actual_damage"), whole),
        }
    )
