"""Support tickets: ratings, custom fields, service levels, and tickets per trip."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetry.functions.clock import boundary_diff, local_from_epoch, to_local
from haulmetry.functions.ratio import percent, ratio
from haulmetry.functions.rows import earliest_per_key, fanout_left_join, latest_per_key, pick_last
from haulmetry.operators.exclusions import (
    ALTERNATE_NAMES,
    SMALL_BUSINESS,
    full_load_demands,
    real_consigners,
    without_partial_comments,
)
from haulmetry.operators.milestones import NOT_DELETED, TRIPS_SINCE, state_epochs

# Custom-field ids, the subject left out, and the long-open limit in minutes.
RESOLVE_TIME_FIELDS = (36, 35)
EXPECTED_TIME_FIELDS = (32, 31)
SUB_REASON_FIELDS = (26, 29)
DEMAND_FIELDS = (8, 24)
FEEDBACK_FIELDS = (37, 38)
ISSUE_FIELD = 10
TRIP_FIELD = 5
APP_SOURCES = ("APP", "App")
BACKOUT_SUBJECT = "Unfulfilled Demand - Operator Backout"
LONG_OPEN_MINUTES = 4_320
TICKET_TRIPS_SINCE = "2023-02-01"
TICKET_RATIO_SINCE = "2023-12-01"


def rating_label(rating: Column) -> Column:
    """BAD under 3, MODERATE at 3, GOOD otherwise (also when missing)."""
    return F.when(rating < 3, "BAD").when(rating == 3, "MODERATE").otherwise("GOOD")


def rating_category(feedback: DataFrame) -> DataFrame:
    """Latest live feedback of each demand with its category."""
    live = feedback.where(F.col("deleted") != "true")
    latest = latest_per_key(live, ["demand_id"], "updated", ["rating"])
    return latest.withColumn("rating_cat", rating_label(F.col("rating")))


def _field(ids: Iterable[int], value: str, any_row: bool = False) -> Column:
    wanted = F.col("custom_field_id").isin(*ids)
    live = wanted if any_row else wanted & (F.col("deleted") != "true")
    return pick_last(F.col("updated"), value, when=live)[value]


def _are_columns(fields: DataFrame) -> bool:
    return "custom_field_id" not in fields.columns


def ticket_demand(fields: DataFrame) -> DataFrame:
    """Demand id recorded on each ticket; of what ``ticket_fields`` made, NULL where there is none."""
    if _are_columns(fields):
        return fields.select("ticket_id", "tt_dem_id")
    kept = fields.where(F.col("custom_field_id").isin(*DEMAND_FIELDS) & (F.col("deleted") != "true"))
    latest = latest_per_key(kept, ["ticket_id"], "updated", ["number_value"])
    return latest.withColumnRenamed("number_value", "tt_dem_id")


def ticket_fields(fields: DataFrame) -> DataFrame:
    """Custom fields as columns, one row per ticket, from one grouped pass; what it made before is taken as it is."""
    if _are_columns(fields):
        return fields
    sets = RESOLVE_TIME_FIELDS + EXPECTED_TIME_FIELDS + SUB_REASON_FIELDS + DEMAND_FIELDS + FEEDBACK_FIELDS
    kept = fields.where(F.col("custom_field_id").isin(*sets))
    columns = kept.groupBy("ticket_id").agg(
        _field(RESOLVE_TIME_FIELDS, "date_value").alias("resolve_epoch"),
        _field(EXPECTED_TIME_FIELDS, "date_value", any_row=True).alias("expected_epoch"),
        _field(SUB_REASON_FIELDS, "string_value").alias("sub_reason"),
        _field(DEMAND_FIELDS, "number_value").alias("tt_dem_id"),
        _field(FEEDBACK_FIELDS, "string_value").alias("ticket_feedback"),
    )
    return columns.select(
        "ticket_id",
        local_from_epoch(F.col("resolve_epoch")).alias("resolve_time"),
        local_from_epoch(F.col("expected_epoch")).alias("expected_res_time"),
        "sub_reason",
        "tt_dem_id",
        "ticket_feedback",
    )


def ticket_sla(
    tickets: DataFrame, fields: DataFrame, as_of: dt.datetime, sources: Iterable[str] = APP_SOURCES
) -> DataFrame:
    """Minutes to resolve or open, promised minutes, and whether the promise was kept."""
    kept = tickets.where(
        (F.col("deleted") != "true") & F.col("source").isin(*sources) & (F.col("subject") != BACKOUT_SUBJECT)
    )
    joined = kept.join(ticket_fields(fields), kept["id"] == F.col("ticket_id"), "left").withColumn(
        "ticket_created_time", to_local(F.col("created"))
    )
    opened, status = F.col("ticket_created_time"), F.col("status")
    now = F.lit(as_of).cast("timestamp_ntz")
    timed = joined.withColumns(
        {
            "resolve_dif": F.when(status == "RESOLVED", boundary_diff("minute", opened, F.col("resolve_time"))),
            "opened_from": F.when(status != "RESOLVED", boundary_diff("minute", opened, now)),
            "tat": boundary_diff("minute", opened, F.col("expected_res_time")),
        }
    )
    active = status == "ACTIVE"
    within = (
        F.when(F.col("resolve_dif") <= F.col("tat"), F.lit(1))
        .when(F.col("resolve_dif").isNotNull(), F.lit(0))
        .cast("int")
    )
    return timed.select(
        "ticket_code",
        "ticket_created_time",
        "tt_dem_id",
        "status",
        "ticket_feedback",
        "resolve_dif",
        "opened_from",
        "tat",
        within.alias("tat_resolve_cat"),
        F.when(active & (F.col("opened_from") > F.col("tat")), "open_abv_tat").alias("tat_chk"),
        F.when(active & (F.col("opened_from") >= LONG_OPEN_MINUTES), "opn_abv_72hrs").alias("op_cat"),
    )


def tickets_fact(
    tickets: DataFrame,
    fields: DataFrame,
    demands: DataFrame,
    feedback: DataFrame,
    consigners: DataFrame,
    consignments: DataFrame,
    states: DataFrame,
    comments: DataFrame,
    as_of: dt.datetime,
    partial_patterns: Iterable[str],
    sources: Iterable[str] = APP_SOURCES,
    excluded_customers: Iterable[str] = (),
    since: str = TRIPS_SINCE,
) -> DataFrame:
    """Tickets raised on completed demands of small businesses, with service levels and rating."""
    live = F.col("deleted") != "true"
    raised = ticket_sla(tickets, fields, as_of, sources).where(
        F.col("ticket_created_time") >= F.lit(since).cast("timestamp_ntz")
    )
    small = (
        real_consigners(consigners.where(live), ALTERNATE_NAMES)
        .where(F.col("type").isin(*SMALL_BUSINESS))
        .select(F.col("code").alias("consigner_user_code"))
    )
    done = full_load_demands(demands.where(F.col("status") == "FULFILLED"))
    listed = list(excluded_customers)
    if listed:
        done = done.where(~F.col("consigner_user_code").isin(*listed))
    done = done.select(F.col("id").alias("demand_id"), "consigner_user_code").join(small, "consigner_user_code", "inner")
    done = without_partial_comments(done, comments, partial_patterns)
    ended = (
        state_epochs(states, ("TRIP_END",), NOT_DELETED)
        .where(F.col("trip_end_epoch").isNotNull())
        .select("code", local_from_epoch(F.col("trip_end_epoch")).alias("trip_start_time"))
    )
    trips = (
        consignments.where((F.col("state") != "CANCELLED") & live).select("demand_id", "code").join(ended, "code", "inner")
    )
    completed = (
        done.join(trips.drop("code"), "demand_id", "inner")
        .join(rating_category(feedback).drop("rating"), "demand_id", "left")
        .select("demand_id", "consigner_user_code", "trip_start_time", "rating_cat")
    )
    return raised.join(completed, raised["tt_dem_id"] == completed["demand_id"], "inner")


def trip_tickets(tickets: DataFrame, fields: DataFrame, activity: DataFrame, source: str) -> DataFrame:
    """Trip tickets with their issue, trip, first hold and resolution times."""
    raised = tickets.where(F.col("source") == source).select(
        F.col("id").alias("ticket_id"), "ticket_code", "status", to_local(F.col("created")).alias("a_created")
    )
    value = F.col("string_value")
    issues = fields.where(F.col("custom_field_id") == ISSUE_FIELD).select("ticket_id", value.alias("issue_identified"))
    trips = fields.where(F.col("custom_field_id") == TRIP_FIELD).select("ticket_id", value.alias("trip_id"))
    moves = activity.where(F.col("field") == "status")
    held = earliest_per_key(moves.where(F.col("new_value") == "HOLD"), ["ticket_id"], "updated", ["updated"]).select(
        "ticket_id", to_local(F.col("updated")).alias("hold_time")
    )
    resolved = moves.where(F.col("new_value") == "RESOLVED").select(
        "ticket_id", to_local(F.col("updated")).alias("resolved_time")
    )
    rows = raised.join(issues.distinct(), "ticket_id", "inner").join(held, "ticket_id", "left")
    rows = fanout_left_join(rows, trips.distinct(), ["ticket_id"])
    rows = fanout_left_join(rows, resolved.distinct(), ["ticket_id"])
    return rows.withColumn("resolved_dur", boundary_diff("hour", F.col("a_created"), F.col("resolved_time")))


def tickets_per_trip(
    consignments: DataFrame,
    demands: DataFrame,
    reports: DataFrame,
    tickets: DataFrame,
    fields: DataFrame,
    activity: DataFrame,
    source: str,
    since: str = TICKET_TRIPS_SINCE,
) -> DataFrame:
    """Per trip, the joined texts of its issues and tickets and the number of issues."""
    raised = trip_tickets(tickets, fields, activity, source).where(F.col("trip_id").isNotNull())
    # One row per trip before the join. The texts are dropped from the plan when only the count is read.
    per_trip = raised.groupBy(F.col("trip_id").alias("code")).agg(
        F.expr("listagg(issue_identified, '/') within group (order by ticket_code, issue_identified)").alias(
            "tickets_created"
        ),
        F.expr("listagg(ticket_code, '/') within group (order by ticket_code)").alias("ticket_codes"),
        F.count("issue_identified").alias("issues"),
    )
    full_loads = full_load_demands(demands).select(F.col("id").alias("demand_id"))
    types = reports.select(F.col("consignment_code").alias("code"), "consigner_type").distinct()
    placed = to_local(F.col("created"))
    trips = (
        consignments.where((F.col("deleted") == "false") & (placed >= F.lit(since).cast("timestamp_ntz")))
        .select("code", "demand_id", placed.alias("placement_time"))
        .join(full_loads, "demand_id", "left_semi")
        .join(types, "code", "left")
        .join(per_trip, "code", "left")
    )
    return trips.select(
        "code",
        "placement_time",
        F.weekofyear("placement_time").alias("week_placed"),
        F.month("placement_time").alias("month_placed"),
        "tickets_created",
        "consigner_type",
        "ticket_codes",
        F.nullif("issues", F.lit(0)).alias("total_tickets"),
    )


def trip_ticket_ratio_daily(per_trip: DataFrame, since: str = TICKET_RATIO_SINCE) -> DataFrame:
    """Daily trips, tickets and ratios, from ``tickets_per_trip``."""
    total = F.col("total_tickets")
    trips = (
        per_trip.where(F.col("placement_time") >= F.lit(since).cast("timestamp_ntz"))
        .groupBy(F.to_date("placement_time").alias("placement_date"), "code")
        .agg(
            F.max(total.isNull()).alias("none"),
            F.coalesce(F.max(total >= 1), F.lit(False)).alias("some"),
            F.sum(total).alias("tickets"),
        )
    )
    daily = trips.groupBy("placement_date").agg(
        F.count("code").alias("trips"),
        F.count_if(F.col("none") & F.col("code").isNotNull()).alias("no_tickets_created_trips"),
        F.count_if(F.col("some") & F.col("code").isNotNull()).alias("trip_atleast_1_tickets"),
        F.sum("tickets").cast("bigint").alias("total_tickets_created"),
    )
    trips_total = F.col("trips")
    return daily.withColumns(
        {
            "ratio_trips_tickets": ratio(F.col("total_tickets_created"), trips_total),
            "no_trips_tickets_pct": percent(F.col("no_tickets_created_trips"), trips_total),
            "trips_tickets_pct": percent(F.col("trip_atleast_1_tickets"), trips_total),
        }
    )
