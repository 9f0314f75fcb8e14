"""Sources, sinks, whole runs, and the shape of physical plans."""

import datetime as dt
import re
from pathlib import Path

import pytest
from conftest import DATA
from pyspark.sql import functions as F

import __spark_entry__ as entry
import checks.queries
from checks.bindings import (
    APP_ID,
    DAMAGE_ASSIGNEE,
    EXCLUDED_CUSTOMERS,
    LINK_BASE,
    PARTIAL_PATTERNS,
    PAYMENT_PARTIAL_PATTERNS,
    PORTAL,
    TRIP_TICKETS,
)
from checks.queries import AS_OF, FIRST_DAY, LAST_DAY
from haulmetry.operators import event_quality, milestones
from haulmetry.operators.app_versions import app_version_rank
from haulmetry.plans.dashboard import DashboardSettings, dashboard_outputs, publish_dashboard
from haulmetry.plans.event_audit import audit_counts, audit_outputs
from haulmetry.sources.readers import event_window, read_app_events, read_table, read_tables
from haulmetry.sources.schemas import SCHEMAS, conform
from haulmetry.sources.sinks import OUTPUT_NAMES, export_csv, publish
from haulmetry.sources.stage import Stage


QUERIES = checks.queries.queries()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return len(re.findall(r"FileScan|Scan ExistingRDD", physical(df)))


def test_event_window():
    assert event_window(dt.date(2024, 3, 2)) == ("20240228", "20240301")


def test_reader_prunes_days_and_columns(spark, sources, tmp_path):
    path = str(tmp_path / "events")
    sources["app_events"].write.partitionBy("event_date").parquet(path)
    read = read_app_events(spark, path, "20240102", "20240103")
    flat = event_quality.event_param_flatten(read, [APP_ID], "20240102", "20240103")
    assert {r.event_date for r in flat.select("event_date").distinct().collect()} == {"20240102", "20240103"}
    spark.conf.set("spark.sql.maxMetadataStringLength", "20000")
    plan = physical(event_quality.event_param_flatten(read, [APP_ID], "20240102", "20240103"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan)
    assert re.search(r"PushedFilters: \[[^\]]*event_name", plan) and "EqualTo(app_info.id" in plan


def test_missing_or_wrong_columns_fail(spark):
    with pytest.raises(ValueError, match="missing columns"):
        conform(spark.range(1), "vehicles")
    with pytest.raises(ValueError, match="not string"):
        conform(spark.range(1).withColumn("vehicle_number", F.lit(1)), "vehicles")


def test_tables_round_trip(spark, sources, tmp_path):
    path = str(tmp_path / "vehicles")
    sources["vehicles"].write.parquet(path)
    assert read_table(spark, path, "vehicles").count() == read_tables(spark, {"vehicles": path})["vehicles"].count()
    with pytest.raises(ValueError, match="unknown source"):
        read_tables(spark, {"nothing": path})


@pytest.mark.parametrize("rows", [[], [("1", "a"), ("1", "a")]])
def test_csv_export_keeps_a_header(spark, tmp_path, rows):
    path = tmp_path / "issues"
    export_csv(spark.createDataFrame(rows, "app_version string, event_name string"), str(path))
    lines = [line for part in path.glob("part-*.csv") for line in part.read_text().splitlines()]
    assert lines.count("app_version,event_name") >= 1
    assert [line for line in lines if line != "app_version,event_name"] == (["1,a"] if rows else [])


def test_publish_overwrites_and_stamps(spark, tmp_path):
    stamp = dt.datetime(2024, 2, 10, 9)
    for value in (1, 2):
        path = publish(spark.range(value, value + 1), str(tmp_path), "dmg_raw", stamp)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(2, stamp)]
    with pytest.raises(ValueError, match="unknown output"):
        publish(spark.range(1), str(tmp_path), "other", stamp)


def test_whole_dashboard(spark, sources, tmp_path):
    tables = {name: sources[name] for name in SCHEMAS if name not in ("app_events", "release_events")}
    settings = DashboardSettings(
        as_of=AS_OF,
        partial_patterns=PARTIAL_PATTERNS,
        payment_partial_patterns=PAYMENT_PARTIAL_PATTERNS,
        portal_source=PORTAL,
        trip_ticket_source=TRIP_TICKETS,
        damage_assignee=DAMAGE_ASSIGNEE,
        ticket_link_base=LINK_BASE,
        excluded_customers=EXCLUDED_CUSTOMERS,
    )
    stage = Stage(spark, str(tmp_path / "stage"))
    paths = publish_dashboard(dashboard_outputs(tables, settings, stage), str(tmp_path), AS_OF)
    assert list((tmp_path / "stage").iterdir())
    stage.clear()
    assert not list((tmp_path / "stage").iterdir())
    assert tuple(paths) == OUTPUT_NAMES
    for name, path in paths.items():
        written = spark.read.parquet(path)
        assert written.count() > 0, name
        assert written.select("refreshed_at").distinct().count() == 1


def test_whole_audit(spark, sources):
    counts = audit_counts(sources["app_events"], [APP_ID], FIRST_DAY, LAST_DAY, Stage(spark))
    # Staged in the folder the session names.
    assert spark.conf.get("spark.checkpoint.dir") in counts.inputFiles()[0]
    history, current = sources.many("release_events_history", "release_events_current")
    outputs = audit_outputs(counts, history, current)
    assert {name: df.count() > 0 for name, df in outputs.items()} == dict.fromkeys(outputs, True)
    funnel = outputs["funnel"]
    total = F.col("total_events")
    assert funnel.where(F.greatest(*event_quality.COUNTERS) > total).count() == 0


LIGHT_NAMES = sorted(set(QUERIES) - {"summary_by_version", "summary_by_version_labelled"})


@pytest.mark.parametrize("name", LIGHT_NAMES)
def test_plans_stay_in_the_engine(spark, name):
    plan = physical(QUERIES[name](spark, DATA))
    for forbidden in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in plan, forbidden


def test_state_log_is_scanned_once(spark, sources):
    assert scans(milestones.state_milestones(sources["consignment_states"])) == 1


def test_aggregates_combine_before_the_shuffle(spark, sources):
    plan = physical(milestones.state_epochs(sources["consignment_states"]))
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning")


def test_ranking_versions_reads_the_counters_once(spark, sources):
    flat = event_quality.event_param_flatten(sources["app_events"], [APP_ID], FIRST_DAY, LAST_DAY)
    ranked = app_version_rank(event_quality.event_quality_counts(flat))
    ranked.collect()
    final = physical(ranked).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_library_uses_no_local_state():
    package = Path(entry.__file__).parent / "haulmetry"
    code = "\n".join(p.read_text() for p in package.rglob("*.py") if "llm" not in p.parts)
    for forbidden in ("localCheckpoint", "tempfile", ".collect()", "toPandas", "crossJoin", ".rdd"):
        assert forbidden not in code, forbidden


@pytest.mark.parametrize("name", ["damage_tickets", "exclude_partial_and_test"])
def test_documents_are_parsed_once(spark, name):
    query = QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    documents = {"damage_tickets": 1, "exclude_partial_and_test": 1}
    assert query.count("from_json") <= documents[name]
