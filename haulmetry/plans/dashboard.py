"""The freight dashboard: source tables in, thirteen named outputs out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetry.operators.cancellations import CANCELLED, cancellation_report, cancellation_rows, cancellations_fact
from haulmetry.operators.damage import damage_daily, damage_tickets
from haulmetry.operators.exclusions import with_load
from haulmetry.operators.gps import gps_offline
from haulmetry.operators.growth import (
    acquisition_base,
    acquisition_funnel,
    calls_per_trip_daily,
    quotes_per_operator_daily,
    subscriptions_cumulative,
)
from haulmetry.operators.milestones import folded_states
from haulmetry.operators.payments import (
    advance_latency_daily,
    balance_latency_daily,
    reported_trips,
    trip_balance,
)
from haulmetry.operators.tickets import (
    APP_SOURCES,
    ticket_fields,
    tickets_fact,
    tickets_per_trip,
    trip_ticket_ratio_daily,
)
from haulmetry.operators.trips import trip_end_fact, trip_enriched
from haulmetry.sources.sinks import publish_together
from haulmetry.sources.stage import Stage


@dataclass(frozen=True)
class DashboardSettings:
    """What differs between deployments."""

    as_of: dt.datetime
    partial_patterns: tuple[str, ...]  # LIKE patterns of a partial-load comment, in ticket reports
    payment_partial_patterns: tuple[str, ...]  # the same, in payment reports
    portal_source: str  # ticket source of the support portal
    trip_ticket_source: str  # ticket source of trip tickets
    damage_assignee: str
    ticket_link_base: str
    excluded_customers: tuple[str, ...] = field(default=())

    @property
    def ticket_sources(self) -> tuple[str, ...]:
        return (*APP_SOURCES, self.portal_source)


# The key by which most outputs join a source table: these tables are large and read by several outputs.
BUCKET_KEYS = {
    "consignment_states": "consignment_code",
    "consignments": "code",
    "demands": "id",
    "demand_comments": "demand_id",
    "trip_reports": "demand_id",
    "ticket_field_values": "ticket_id",
    "tickets": "id",
}
#: Rows of the state log that are read one by one, which ``colocated`` keeps beside the folded log.
CANCELLED_STATES = "cancelled_states"


def colocated(t: Mapping[str, DataFrame], stage: Stage, buckets: int | None = None) -> dict[str, DataFrame]:
    """The source tables, those of ``BUCKET_KEYS`` written once in as many buckets by their key.

    The state log, from which four outputs take times by trip, is folded to a row for each trip on the
    way, and its cancellations are kept beside it; the partial-load flag of demands is parsed. These and
    the tables they meet are then shuffled once for the whole run instead of once for each output.
    """
    tables = dict(t)
    for name, key in BUCKET_KEYS.items():
        if name in tables:
            count = buckets or int(tables[name].sparkSession.conf.get("spark.sql.shuffle.partitions"))
            if name == "consignment_states":
                tables[CANCELLED_STATES] = stage.keep(tables[name].where(F.col("state") == CANCELLED))
                tables[name] = stage.keep_bucketed(folded_states(tables[name]), "code", count, one_each=True)
            elif name == "demands":
                tables[name] = stage.keep_bucketed(with_load(tables[name]), key, count)
            else:
                tables[name] = stage.keep_bucketed(tables[name], key, count)
    return tables


def dashboard_outputs(t: Mapping[str, DataFrame], s: DashboardSettings, stage: Stage) -> dict[str, DataFrame]:
    """All outputs by name. Tables that feed several outputs are staged while the plans are built.

    Pass the tables through ``colocated`` first, and clear ``stage`` once the outputs are written.
    """
    columns = stage.keep(ticket_fields(t["ticket_field_values"]))
    tickets = tickets_fact(
        t["tickets"],
        columns,
        t["demands"],
        t["demand_feedback"],
        t["consigners"],
        t["consignments"],
        t["consignment_states"],
        t["demand_comments"],
        s.as_of,
        s.partial_patterns,
        s.ticket_sources,
        s.excluded_customers,
    )
    tickets = stage.keep(tickets)
    trips = trip_end_fact(
        t["consignments"],
        t["demands"],
        t["consignment_states"],
        t["demand_feedback"],
        t["consigners"],
        t["demand_addresses"],
        keep=stage.keep,
    )
    gps = gps_offline(
        t["consignments"],
        t["vehicle_details"],
        t["vehicles"],
        t["device_history"],
        t["consignment_states"],
        keep=stage.keep,
    )
    damage = damage_tickets(
        t["tickets"],
        columns,
        t["damage_claims"],
        t["consignments"],
        t["demands"],
        t["consigners"],
        s.portal_source,
        s.damage_assignee,
        s.ticket_link_base,
        keep=stage.keep,
    )
    cancellations = cancellations_fact(
        stage.keep(
            cancellation_rows(
                t["consignments"],
                t.get(CANCELLED_STATES, t["consignment_states"]),
                t["demands"],
                t["consigners"],
                t["vehicle_types"],
                t["demand_tokens"],
            )
        )
    )
    per_trip = tickets_per_trip(
        t["consignments"],
        t["demands"],
        t["trip_reports"],
        t["tickets"],
        t["ticket_field_values"],
        t["ticket_activity"],
        s.trip_ticket_source,
    )
    acquired = stage.keep(
        acquisition_base(
            t["subscriptions"],
            t["quotations"],
            t["consignments"],
            t["operator_profiles"],
            t["rate_inputs"],
            s.as_of.date(),
        )
    )
    reported = stage.keep(
        reported_trips(
            t["consignments"],
            t["trip_reports"],
            t["demands"],
            t["consigners"],
            t["demand_comments"],
            s.payment_partial_patterns,
        )
    )
    balance = stage.keep(trip_balance(t["trip_reports"], t["expenses"], t["bank_payments"]))
    return {
        "dmg_raw": damage_daily(t["consignments"], t["demands"], t["consignment_states"], damage),
        "tickets": tickets,
        # Written once, because ordering it reads it twice: for the ranges and to deal it.
        "trip_end_raw": stage.keep(trip_enriched(trips, tickets, gps, keep=stage.keep)),
        "can_raw": cancellation_report(cancellations),
        "sub_raw": subscriptions_cumulative(t["subscriptions"]),
        "fo_tkts": trip_ticket_ratio_daily(per_trip),
        "avg_quotes": quotes_per_operator_daily(t["quotations"]),
        "acq_pod_dod": acquisition_funnel(acquired, "day"),
        "acq_pod_wow": acquisition_funnel(acquired, "week"),
        "acq_pod_mom": acquisition_funnel(acquired, "month"),
        "Call_fo": calls_per_trip_daily(t["consignments"], t["demands"], t["call_records"], t["call_crm"]),
        "advance_op_payment": advance_latency_daily(reported, t["operator_transactions"], balance),
        "bal_op_payment": balance_latency_daily(reported, t["bank_payments"], balance),
    }


def publish_dashboard(outputs: Mapping[str, DataFrame], root: str, refreshed_at: dt.datetime) -> dict[str, str]:
    """Publish every output, ordered and stamped with the run time, in one commit; returns their paths."""
    return publish_together(outputs, root, refreshed_at)
