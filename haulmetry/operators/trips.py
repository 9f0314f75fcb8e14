"""The trip-end fact and its enrichment with tickets and GPS."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetry.functions.clock import calendar_labels, local_from_epoch
from haulmetry.functions.rows import Keep, as_is, fanout_left_join
from haulmetry.operators.exclusions import TEST_NAMES, real_consigners
from haulmetry.operators.milestones import TRIPS_SINCE, bucketed_trips, demand_buckets, trip_times
from haulmetry.operators.requests import special_request_flag


def trip_end_fact(
    consignments: DataFrame,
    demands: DataFrame,
    states: DataFrame,
    feedback: DataFrame,
    consigners: DataFrame,
    addresses: DataFrame,
    since: str = TRIPS_SINCE,
    test_names: Iterable[str] = TEST_NAMES,
    keep: Keep = as_is,
) -> DataFrame:
    """One row per ended trip, feedback entry and delay bucket of its demand.

    ``keep`` is given what is read twice: the ended trips with their buckets, and the ratings.
    """
    times = keep(bucketed_trips(trip_times(consignments, demands, states, since)))
    named = real_consigners(consigners, test_names).select(F.col("code").alias("consigner_user_code"))
    # Only the existence of the customer matters to a distinct result, so a semi join is enough.
    trips = (
        times.where(F.col("ptl") != "true")
        .join(named, "consigner_user_code", "left_semi")
        .select("code", "demand_id", local_from_epoch(F.col("trip_end_epoch")).alias("unloading_done_time"))
    )
    requests = special_request_flag(demands, addresses)
    # Join each demand's bucket sets as arrays and unfold them afterwards: a demand with very
    # many trips then costs one joined row per trip instead of all pairs of its trips.
    enriched = trips.join(demand_buckets(times), "demand_id", "left").join(requests, "demand_id", "left")
    unfolded = enriched.withColumn("gtl_delay", F.explode("gtl_delays")).withColumn(
        "trnst", F.explode("trnst_dlys")
    )
    ratings = feedback.select("demand_id", "rating", "remarks", "reasons").distinct()
    return (
        fanout_left_join(unfolded, ratings, ["demand_id"], keep=keep)
        .select(
            "demand_id",
            "unloading_done_time",
            "rating",
            "remarks",
            "reasons",
            "gtl_delay",
            F.nullif("trnst", F.lit("")).alias("sys_trnst_dly"),
            "code",
            "sr_demand",
            "express_delivery",
        )
        .distinct()
    )


def trip_enriched(trips: DataFrame, tickets: DataFrame, gps: DataFrame, keep: Keep = as_is) -> DataFrame:
    """Trips with calendar labels, one row per ticket of the demand, and offline hours.

    ``tickets`` is read twice: pass it staged, or ``keep`` it here.
    """
    raised = tickets.select("demand_id", "ticket_code", "ticket_feedback", "opened_from", "tat_resolve_cat")
    offline = gps.select("code", "trip_journey", "total_offline_time", "sim_network", "transit_journey")
    labelled = calendar_labels(trips, "unloading_done_time", with_date=True)
    return fanout_left_join(labelled, raised, ["demand_id"], keep=keep).join(offline, "code", "left")
