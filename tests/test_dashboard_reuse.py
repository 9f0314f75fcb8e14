"""What the dashboard's outputs share: a folded state log, parsed flags, kept tables, joins that need no salt."""

import datetime as dt
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from checks.bindings import DAMAGE_ASSIGNEE, LINK_BASE, PORTAL
from checks.queries import DASHBOARD
from haulmetry.functions.rows import fanout_left_join
from haulmetry.operators import damage, exclusions, milestones, tickets, trips
from haulmetry.plans.dashboard import CANCELLED_STATES, colocated, dashboard_outputs
from haulmetry.sources.schemas import SCHEMAS
from haulmetry.sources.sinks import MANIFEST, RUNS, drop_old_runs
from haulmetry.sources.stage import Stage


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture()
def log(spark):
    rng = random.Random(7)
    times = [None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 0, 0, 0, 1)]
    states = [*milestones.STATES, "CANCELLED", "OTHER", None]
    made = [
        (rng.choice([None, *"abcdefgh"]), rng.choice(states), rng.choice([None, 5, 7, -3]), rng.choice(times), rng.choice(["false", "true", "odd", None]))
        for _ in range(600)
    ]
    made += [("only-odd", "TRIP_END", 4, None, "odd"), ("unset", "TRIP_END", None, None, "false"), ("early", "AT_LOADING", 1, None, "false")]
    return spark.createDataFrame(made, "consignment_code string, state string, time bigint, updated timestamp_ntz, deleted string")


def test_a_folded_log_gives_the_times_of_the_log(log):
    folded = milestones.folded_states(log)
    wanted = [milestones.STATES, milestones.STATES[:4], ("TRIP_END",), ("AT_LOADING", "TRIP_END")]
    for some in wanted:
        want = rows(milestones.state_epochs(log, some))
        assert want and rows(milestones.state_epochs(folded, some)) == want
    some = (folded, ("TRIP_END",), milestones.NOT_DELETED)
    assert rows(milestones.state_epochs(*some)) == rows(milestones.state_epochs(log, *some[1:]))
    assert "Row(code='only-odd', trip_end_epoch=4)" in rows(milestones.state_epochs(*some))


def test_the_outputs_share_one_fold_and_one_parse(spark, sources, tmp_path):
    tables = {name: sources[name] for name in SCHEMAS if name not in ("app_events", "release_events")}
    stage = Stage(spark, str(tmp_path / "stage"))
    near = colocated(tables, stage, 4)
    for mark in (milestones.LIVE, milestones.NOT_DELETED):
        assert "Aggregate" not in physical(milestones.state_epochs(near["consignment_states"], ("TRIP_END",), mark))
        want = rows(milestones.state_epochs(tables["consignment_states"], ("TRIP_END",), mark).where("trip_end_epoch is not null"))
        assert rows(milestones.state_epochs(near["consignment_states"], ("TRIP_END",), mark).where("trip_end_epoch is not null")) == want
    cancelled = tables["consignment_states"].where("state = 'CANCELLED'")
    assert rows(near[CANCELLED_STATES]) == rows(cancelled) != []
    loads = [exclusions.full_load_demands(t["demands"]).select("id", "metadata") for t in (near, tables)]
    assert "from_json" not in physical(loads[0]) and rows(loads[0]) == rows(loads[1])
    outputs = dashboard_outputs(near, DASHBOARD, stage)
    # The largest output is a written table before it is put in order, which reads it twice.
    assert not any(step in physical(outputs["trip_end_raw"]) for step in ("Join", "Aggregate", "Exchange"))
    plain = dashboard_outputs(tables, DASHBOARD, stage)
    for name in outputs:
        assert rows(outputs[name]) == rows(plain[name]) != [], name
    stage.clear()


@pytest.mark.parametrize("hot", [False, True])
def test_a_kept_right_side_joins_plainly_unless_a_key_is_hot(spark, tmp_path, hot):
    stage = Stage(spark, str(tmp_path))
    left = spark.createDataFrame([(k, n) for k, n in itertools.product([None, 0, 1, 2, 9], range(3))], "k int, l int")
    right = spark.createDataFrame([(None, 1), (1, 1), (1, 1), (2, None), *[(0, n % 4) for n in range(50)]], "k int, r int")
    want = rows(left.join(right, "k", "left"))
    for same in (False, True):
        got = fanout_left_join(left, right, ["k"], same, 3 if hot else 100, stage.keep)
        assert rows(got.select("k", "l", "r")) == want
        assert ("_salt" in physical(got)) == hot
    stage.clear()


def test_kept_and_computed_trips_and_claims_are_the_same(spark, sources, tmp_path):
    stage = Stage(spark, str(tmp_path))
    names = ("consignments", "demands", "consignment_states", "demand_feedback", "consigners", "demand_addresses")
    sides = sources.many(*names)
    assert rows(trips.trip_end_fact(*sides, keep=stage.keep)) == rows(trips.trip_end_fact(*sides)) != []
    names = ("tickets", "ticket_field_values", "damage_claims", "consignments", "demands", "consigners")
    raw, fields, *others = sources.many(*names)
    found = damage.damage_tickets(raw, fields, *others, PORTAL, DAMAGE_ASSIGNEE, LINK_BASE)
    columns = stage.keep(tickets.ticket_fields(fields))
    kept = damage.damage_tickets(raw, columns, *others, PORTAL, DAMAGE_ASSIGNEE, LINK_BASE, keep=stage.keep)
    assert rows(kept) == rows(found) != []
    # Claims meet the demands with a ticket before their document is parsed.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan[plan.index("from_json") :]
    stage.clear()


def test_bucket_names_of_a_demand(spark):
    names = [name for _, name in milestones.LOADING_BUCKETS] + [milestones.LOADING_LAST]
    made = [(1, names[0], ""), (1, names[0], "dely_undr_24"), (1, names[3], ""), (None, names[1], "ontime"), (2, names[2], "dely_abv_48")]
    found = milestones.demand_buckets(spark.createDataFrame(made, "demand_id int, gtl_delay string, trnst_dly string"))
    assert "ObjectHashAggregate" not in physical(found)
    got = {r.demand_id: (set(r.gtl_delays), set(r.trnst_dlys)) for r in found.collect()}
    assert got == {1: ({names[0], names[3]}, {"", "dely_undr_24"}), None: ({names[1]}, {"ontime"}), 2: ({names[2]}, {"dely_abv_48"})}


def test_the_published_run_is_the_newest_of_its_time(spark, tmp_path):
    first, published, failed = names = ["20240201T000000-c", "20240202T000000-a", "20240202T000000-b"]
    for name in names:
        (tmp_path / RUNS / name).mkdir(parents=True)
    (tmp_path / MANIFEST).write_text(json.dumps({"run": published, "outputs": []}))
    assert sorted(drop_old_runs(spark, str(tmp_path), keep=1)) == [first, failed]
    assert [p.name for p in (tmp_path / RUNS).iterdir()] == [published]
