"""Registered queries: every operator run over the given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.bindings import (
    APP_ID,
    DAMAGE_ASSIGNEE,
    EXCLUDED_CUSTOMERS,
    LINK_BASE,
    PARTIAL_PATTERNS,
    PAYMENT_PARTIAL_PATTERNS,
    PORTAL,
    TRIP_TICKETS,
    SparkSources,
)
from haulmetry.functions.clock import calendar_labels
from haulmetry.operators import app_versions as versions
from haulmetry.operators import cancellations, damage, event_issues, event_quality, exclusions, gps, growth
from haulmetry.operators import kpi, milestones, payments, requests, tickets, trips
from haulmetry.plans import daily_counts, dashboard, event_audit
from haulmetry.session import tune
from haulmetry.sources.readers import read_app_events
from haulmetry.sources.schemas import SCHEMAS
from haulmetry.sources.sinks import ORDERED_BY, export_csv, publish, read_published
from haulmetry.sources.stage import Stage
from haulmetry.streaming import event_counts

FIRST_DAY, LAST_DAY = "20240101", "20240131"
AS_OF = dt.datetime(2024, 2, 10, 9, 30)
SOURCES = (*tickets.APP_SOURCES, PORTAL)
DASHBOARD = dashboard.DashboardSettings(
    as_of=AS_OF,
    partial_patterns=PARTIAL_PATTERNS,
    payment_partial_patterns=PAYMENT_PARTIAL_PATTERNS,
    portal_source=PORTAL,
    trip_ticket_source=TRIP_TICKETS,
    damage_assignee=DAMAGE_ASSIGNEE,
    ticket_link_base=LINK_BASE,
    excluded_customers=EXCLUDED_CUSTOMERS,
)
FLAGS = ("overall", *[f"app_latest_{n}" for n in range(10)])
# Words of the document texts, charged as cancellation codes are.
TEXT_RULES = (
    ("apache_license", "License"),
    ("all_rights_reserved", "License"),
    ("password", "Secret"),
    ("e_mail", "Contact"),
    ("the", "English"),
    ("und", "German"),
)


def working_folder(spark: SparkSession) -> str:
    """The session's shared folder; a session without one, on one machine, gets a folder of the checks."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return folder or f"/tmp/haulmetry-checks/{spark.sparkContext.applicationId}"


class Queries:
    """One method per registered query."""

    def __init__(self, spark: SparkSession, folder: str):
        self.t = SparkSources(tune(spark), folder)
        self._spark, self._folder = spark, working_folder(spark)
        self._stage = Stage(spark, self._folder)

    # Event audit

    def event_param_flatten(self) -> DataFrame:
        return event_quality.event_param_flatten(self.t["app_events"], [APP_ID], FIRST_DAY, LAST_DAY)

    def event_quality_counts(self) -> DataFrame:
        return event_quality.event_quality_counts(self.event_param_flatten())

    def event_quality_counts_by_day(self) -> DataFrame:
        """Two overlapping windows counted into kept days, one after the other."""
        path = f"{self._folder}/days-{uuid.uuid4().hex}"
        for start, end in ((FIRST_DAY, "20240118"), ("20240115", LAST_DAY)):
            daily_counts.refresh_days(self.t["app_events"], [APP_ID], start, end, path)
        return daily_counts.read_days(self._spark, path, FIRST_DAY, LAST_DAY)

    def event_quality_counts_streamed(self) -> DataFrame:
        """The same counters from a stream over the events, written as files, a few files a batch."""
        log, path, progress = (f"{self._folder}/{name}-{uuid.uuid4().hex}" for name in ("files", "streamed", "progress"))
        self.t["app_events"].repartition(8).write.parquet(log)
        events = event_counts.read_event_stream(self._spark, log, files_per_batch=4)
        # All files hold all days, so the whole window may be late.
        query = event_counts.start_counting(events, [APP_ID], FIRST_DAY, LAST_DAY, path, progress, lateness="62 days")
        query.awaitTermination()
        return daily_counts.read_days(self._spark, path, FIRST_DAY, LAST_DAY)

    def app_version_rank(self) -> DataFrame:
        return versions.app_version_rank(self.event_quality_counts())

    def release_date_first_seen(self) -> DataFrame:
        history, current = self.t.many("release_events_history", "release_events_current")
        return versions.release_date_first_seen(history, current, self._ranked())

    @cached_property
    def _counts(self) -> DataFrame:
        return event_audit.audit_counts(self.t["app_events"], [APP_ID], FIRST_DAY, LAST_DAY, self._stage)

    def event_log_window(self) -> DataFrame:
        """The same window from a log that is partitioned by day."""
        path = f"{self._folder}/log-{uuid.uuid4().hex}"
        self.t["app_events"].write.partitionBy("event_date").parquet(path)
        events = read_app_events(self._spark, path, FIRST_DAY, LAST_DAY)
        return event_quality.event_param_flatten(events, [APP_ID], FIRST_DAY, LAST_DAY)

    def _ranked(self) -> DataFrame:
        return versions.app_version_rank(self._counts)

    def version_tagging(self) -> DataFrame:
        return versions.version_tagging(self._counts, self._ranked())

    def event_signature(self) -> DataFrame:
        return event_quality.event_signature(self.version_tagging())

    def quality_miss_pct(self) -> DataFrame:
        return event_quality.quality_miss_pct(self.event_signature())

    def quality_miss_pct_by_version(self) -> DataFrame:
        return event_quality.quality_miss_pct(self.event_signature(), by_version=True)

    def compliance_funnel(self) -> DataFrame:
        return event_quality.compliance_funnel(self.event_signature())

    def compliance_rates(self) -> DataFrame:
        return event_quality.compliance_rates(self.compliance_funnel())

    def _labels(self) -> DataFrame:
        return self._ranked().join(self.release_date_first_seen(), "app_version", "left")

    def summary_long(self) -> DataFrame:
        return event_issues.summary_long(self.compliance_rates(), self._labels())

    def summary_by_version(self) -> DataFrame:
        plain = self._ranked().select("app_version", "row_number", F.col("row_number").alias("app_version_1"))
        return event_issues.summary_by_version(event_issues.summary_long(self.compliance_rates(), plain), FLAGS)

    def summary_by_version_labelled(self) -> DataFrame:
        """One column per version by its label, as the audit shows them, and back to rows to be compared."""
        wide = event_issues.summary_by_version(self.summary_long())
        return wide.unpivot(["key_name", "metrics"], [F.col(f"`{c}`") for c in wide.columns[2:]], "app_version", "value")

    def breach_flag(self) -> DataFrame:
        return event_issues.breach_flag(self.summary_long())

    def issue_classifier(self) -> DataFrame:
        return event_issues.issue_classifier(self.event_signature())

    def issue_classifier_all_keys(self) -> DataFrame:
        return event_issues.issue_classifier(self.event_signature(), drop_null_keys=False)

    def issue_latest_version(self) -> DataFrame:
        return event_issues.issue_latest_version(self.issue_classifier(), self._ranked())

    def issue_export(self) -> DataFrame:
        return event_issues.issue_export(self.issue_latest_version())

    def issue_export_csv(self) -> DataFrame:
        """The issue list written as CSV and read back."""
        path = f"{self._folder}/issues-{uuid.uuid4().hex}"
        export_csv(self.issue_export(), path)
        return self._spark.read.option("header", True).csv(path)

    # Trips

    def special_request_flag(self) -> DataFrame:
        return requests.special_request_flag(*self.t.many("demands", "demand_addresses"))

    def state_milestones(self) -> DataFrame:
        return milestones.state_milestones(self.t["consignment_states"])

    def _times(self) -> DataFrame:
        return milestones.trip_times(*self.t.many("consignments", "demands", "consignment_states"))

    def loading_delay_bucket(self) -> DataFrame:
        return milestones.loading_delay_bucket(self._times())

    def transit_delay_bucket(self) -> DataFrame:
        return milestones.transit_delay_bucket(self._times())

    def trip_end_fact(self) -> DataFrame:
        names = ("consignments", "demands", "consignment_states", "demand_feedback", "consigners", "demand_addresses")
        return trips.trip_end_fact(*self.t.many(*names))

    def calendar_labels(self) -> DataFrame:
        placed = self.t["consignments"].select("code", "created")
        return calendar_labels(placed, "created", with_date=True)

    def gps_offline(self) -> DataFrame:
        names = ("consignments", "vehicle_details", "vehicles", "device_history", "consignment_states")
        return gps.gps_offline(*self.t.many(*names))

    def trip_enriched(self) -> DataFrame:
        return trips.trip_enriched(self.trip_end_fact(), self._stage.keep(self.tickets_fact()), self.gps_offline())

    def exclude_partial_and_test(self) -> DataFrame:
        demands, consigners, comments = self.t.many("demands", "consigners", "demand_comments")
        return exclusions.exclude_partial_and_test(
            demands, consigners, comments, PARTIAL_PATTERNS, EXCLUDED_CUSTOMERS
        )

    # Tickets and damage

    def rating_category(self) -> DataFrame:
        return tickets.rating_category(self.t["demand_feedback"])

    def ticket_fields(self) -> DataFrame:
        return tickets.ticket_fields(self.t["ticket_field_values"])

    def ticket_sla(self) -> DataFrame:
        return tickets.ticket_sla(*self.t.many("tickets", "ticket_field_values"), AS_OF, SOURCES)

    def tickets_fact(self) -> DataFrame:
        names = (
            "tickets",
            "ticket_field_values",
            "demands",
            "demand_feedback",
            "consigners",
            "consignments",
            "consignment_states",
            "demand_comments",
        )
        return tickets.tickets_fact(*self.t.many(*names), AS_OF, PARTIAL_PATTERNS, SOURCES, EXCLUDED_CUSTOMERS)

    def trip_tickets(self) -> DataFrame:
        return tickets.trip_tickets(*self.t.many("tickets", "ticket_field_values", "ticket_activity"), TRIP_TICKETS)

    def tickets_per_trip(self) -> DataFrame:
        names = ("consignments", "demands", "trip_reports", "tickets", "ticket_field_values", "ticket_activity")
        return tickets.tickets_per_trip(*self.t.many(*names), TRIP_TICKETS)

    def trip_ticket_ratio_daily(self) -> DataFrame:
        return tickets.trip_ticket_ratio_daily(self.tickets_per_trip())

    def damage_tickets(self) -> DataFrame:
        names = ("tickets", "ticket_field_values", "damage_claims", "consignments", "demands", "consigners")
        return damage.damage_tickets(*self.t.many(*names), PORTAL, DAMAGE_ASSIGNEE, LINK_BASE)

    def damage_daily(self) -> DataFrame:
        sides = self.t.many("consignments", "demands", "consignment_states")
        return damage.damage_daily(*sides, self.damage_tickets())

    # Cancellations

    def cancel_reason(self) -> DataFrame:
        charged = cancellations.charged(self.t["consignment_states"])
        return charged.select("consignment_code", "time", "remarks", "placed_cancel_reason")

    def cancel_reason_documents(self) -> DataFrame:
        owner = cancellations.cancel_reason(F.col("text"), TEXT_RULES)
        return self.t.table("documents").select("doc_id", owner.alias("owner"))

    def cancellations_fact(self) -> DataFrame:
        names = ("consignments", "consignment_states", "demands", "consigners", "vehicle_types", "demand_tokens")
        return cancellations.cancellations_fact(self._stage.keep(cancellations.cancellation_rows(*self.t.many(*names))))

    def cancellation_report(self) -> DataFrame:
        return cancellations.cancellation_report(self.cancellations_fact())

    # Growth

    def subscriptions_cumulative(self) -> DataFrame:
        return growth.subscriptions_cumulative(self.t["subscriptions"])

    def quotes_per_operator_daily(self) -> DataFrame:
        return growth.quotes_per_operator_daily(self.t["quotations"])

    def _acquired(self) -> DataFrame:
        names = ("subscriptions", "quotations", "consignments", "operator_profiles", "rate_inputs")
        return growth.acquisition_base(*self.t.many(*names), AS_OF.date())

    def acquisition_funnel_daily(self) -> DataFrame:
        return growth.acquisition_funnel(self._acquired(), "day")

    def acquisition_funnel_weekly(self) -> DataFrame:
        return growth.acquisition_funnel(self._acquired(), "week")

    def acquisition_funnel_monthly(self) -> DataFrame:
        return growth.acquisition_funnel(self._acquired(), "month")

    def calls_per_trip_daily(self) -> DataFrame:
        return growth.calls_per_trip_daily(*self.t.many("consignments", "demands", "call_records", "call_crm"))

    # Payments

    def _balance(self) -> DataFrame:
        return payments.trip_balance(*self.t.many("trip_reports", "expenses", "bank_payments"))

    def trip_balance(self) -> DataFrame:
        rounded = {name: F.round(name, 4) for name in ("opadd", "opsub", "tds", "oppaid", "trip_bal")}
        return self._balance().withColumns(rounded)

    def _reported(self) -> DataFrame:
        names = ("consignments", "trip_reports", "demands", "consigners", "demand_comments")
        return payments.reported_trips(*self.t.many(*names), PAYMENT_PARTIAL_PATTERNS)

    def advance_latency_daily(self) -> DataFrame:
        return payments.advance_latency_daily(self._reported(), self.t["operator_transactions"], self._balance())

    def balance_latency_daily(self) -> DataFrame:
        return payments.balance_latency_daily(self._reported(), self.t["bank_payments"], self._balance())

    # Outputs

    def publish_stamped(self) -> DataFrame:
        """An output written, stamped with its run time, and read back."""
        root = f"{self._folder}/published-{uuid.uuid4().hex}"
        return self._spark.read.parquet(publish(self.quotes_per_operator_daily(), root, "avg_quotes", AS_OF))

    def published_outputs(self) -> DataFrame:
        """The whole dashboard from co-located tables, published in one commit: rows and newest entry of each output."""
        root = f"{self._folder}/dashboard-{uuid.uuid4().hex}"
        tables = {name: self.t[name] for name in SCHEMAS if name not in ("app_events", "release_events")}
        outputs = dashboard.dashboard_outputs(dashboard.colocated(tables, self._stage), DASHBOARD, self._stage)
        dashboard.publish_dashboard(outputs, root, AS_OF)
        self._stage.clear()  # what is published stands on its own
        found = [
            read_published(self._spark, root, name).agg(
                F.lit(name).alias("output"),
                F.count("*").alias("n_rows"),
                F.max(F.col(ORDERED_BY[name]).cast("date")).alias("newest"),
                F.max("refreshed_at").alias("refreshed_at"),
            )
            for name in outputs
        ]
        return reduce(DataFrame.unionByName, found)

    def kpi_long(self) -> DataFrame:
        return kpi.kpi_long(
            [
                ("fo_tkts", self.trip_ticket_ratio_daily(), "placement_date"),
                ("avg_quotes", self.quotes_per_operator_daily(), "quote_date"),
                ("Call_fo", self.calls_per_trip_daily(), "day"),
            ]
        )


NAMES = tuple(name for name in vars(Queries) if not name.startswith("_"))


def _query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return getattr(Queries(spark, folder), name)()

    run.__name__ = name
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(name) for name in NAMES}
