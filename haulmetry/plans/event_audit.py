"""The event audit from nested events to summary, breaches and issue list."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from haulmetry.operators.app_versions import app_version_rank, release_date_first_seen, version_tagging
from haulmetry.operators.event_issues import (
    breach_flag,
    issue_classifier,
    issue_export,
    issue_latest_version,
    summary_long,
)
from haulmetry.operators.event_quality import (
    compliance_funnel,
    compliance_rates,
    event_param_flatten,
    event_quality_counts,
    event_signature,
)
from haulmetry.sources.stage import Stage


def audit_counts(events: DataFrame, app_ids: Iterable[str], start: str, end: str, stage: Stage) -> DataFrame:
    """Quality counters of the window: the one pass over raw events that everything else reads.

    They are staged, because versions, funnel and issues all start from them and they are
    small next to the events.
    """
    return stage.keep(event_quality_counts(event_param_flatten(events, app_ids, start, end)))


def audit_outputs(
    counts: DataFrame, history: DataFrame, current: DataFrame, latest_version: str | None = None
) -> dict[str, DataFrame]:
    """Every audit table, from the counters and the two release-event tables."""
    ranked = app_version_rank(counts, latest_version)
    released = release_date_first_seen(history, current, ranked)
    labels = ranked.join(released, "app_version", "left")
    tagged = event_signature(version_tagging(counts, labels))
    funnel = compliance_funnel(tagged)
    summary = breach_flag(summary_long(compliance_rates(funnel), labels))
    issues = issue_latest_version(issue_classifier(tagged), labels)
    return {"versions": labels, "funnel": funnel, "summary": summary, "issues": issue_export(issues)}
