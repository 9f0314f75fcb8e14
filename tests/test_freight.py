"""Freight operators on rows made by hand, and against brute force."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from haulmetry.functions.rows import dealt_in_order, fanout_left_join, ordinal_within
from haulmetry.operators import cancellations, gps, growth, milestones, payments, requests, tickets
from haulmetry.sources.schemas import schema


def frame(spark, name, rows):
    fields = schema(name)
    return spark.createDataFrame([tuple(row.get(f) for f in fields.names) for row in rows], fields)


def test_cancel_rules():
    owners = Counter(owner for _, owner in cancellations.CANCEL_RULES)
    assert owners == {"Consigner": 35, "Operator": 32, "Other": 11, "Tech": 1, "Kyc": 1}


@pytest.mark.parametrize(
    ("remark", "owner"),
    [
        ("x KYC_ISSUE_CONSIGNMENT_CANCELLATION y", "Kyc"),
        ("kyc-issue-consignment\ncancellation", "Kyc"),
        ("KYC_ISSUE_CONSIGNMENT_CANCELLATION TECH_ISSUE_CONSIGNMENT_CANCELLATION", "Kyc"),
        ("TECH_ISSUE_CONSIGNMENT_CANCELLATION KYC_ISSUE_CONSIGNMENT_CANCELLATION", "Kyc"),
        ("tech_issue_consignment_cancellation", "Tech"),
        ("TECHISSUE_CONSIGNMENT_CANCELLATION", None),
        ("", None),
        (None, None),
    ],
)
def test_cancel_reason(spark, remark, owner):
    row = spark.createDataFrame([(remark,)], "r string").select(cancellations.cancel_reason(F.col("r")).alias("o"))
    assert row.first().o == owner


@pytest.mark.parametrize(
    ("minutes", "bucket"),
    [(-5, "ontime"), (1, "ontime"), (2, "delay_2hr"), (120, "delay_2hr"), (121, "delay_2hr_to_4hr"),
     (240, "delay_2hr_to_4hr"), (241, "delay_4hours+"), (None, "delay_4hours+")],
)
def test_loading_bucket(spark, minutes, bucket):
    row = spark.createDataFrame([(minutes,)], "m bigint").select(milestones.loading_bucket(F.col("m")).alias("b"))
    assert row.first().b == bucket


@pytest.mark.parametrize(
    ("hours", "bucket"),
    [(0.0, "ontime"), (0.5, "dely_undr_24"), (24.0, "dely_undr_24"), (48.0, "dely_undr_48"), (48.1, "dely_abv_48"),
     (None, None)],
)
def test_transit_bucket(spark, hours, bucket):
    row = spark.createDataFrame([(hours,)], "h double").select(milestones.transit_bucket(F.col("h")).alias("b"))
    assert row.first().b == bucket


@pytest.mark.parametrize(
    ("minutes", "balance", "bucket"),
    [(359, 900.0, "LessThan6Hr"), (360, 900.0, "Btw6to12Hr"), (720, 900.0, "Btw6to12Hr"),
     (721, 900.0, "Btw12to24Hr"), (1440, 900.0, "Btw12to24Hr"), (1441, 900.0, "Morethan24Hr"),
     (None, 199.0, "LessThan6Hr"), (None, 200.0, None), (None, None, "LessThan6Hr")],
)
def test_latency_bucket(spark, minutes, balance, bucket):
    row = spark.createDataFrame([(minutes, balance)], "m bigint, trip_bal double")
    settled = payments._little_left() & F.col("m").isNull()
    assert row.select(payments.latency_bucket(F.col("m"), settled).alias("b")).first().b == bucket


def test_milestones_take_the_latest_live_row(spark):
    day = dt.datetime(2024, 1, 1)
    log = [
        {"consignment_code": "a", "state": "TRIP_END", "time": 0, "updated": day, "deleted": "false"},
        {"consignment_code": "a", "state": "TRIP_END", "time": 60, "updated": day + dt.timedelta(1), "deleted": "false"},
        {"consignment_code": "a", "state": "TRIP_END", "time": 90, "updated": day + dt.timedelta(2), "deleted": "true"},
        {"consignment_code": "b", "state": "AT_LOADING", "time": 30, "updated": None, "deleted": "false"},
        {"consignment_code": "b", "state": "AT_LOADING", "time": 20, "updated": day, "deleted": "false"},
    ]
    got = {r.code: r for r in milestones.state_milestones(frame(spark, "consignment_states", log)).collect()}
    assert got["a"].trip_end_time == dt.datetime(1970, 1, 1, 5, 31) and got["a"].at_loading_time is None
    assert got["b"].at_loading_time == dt.datetime(1970, 1, 1, 5, 30, 30)


def test_special_requests(spark):
    created = dt.datetime(2024, 1, 1)
    docs = [None, "{}", '{"specialRequestBody": {"overHeight": "0"}}', '{"specialRequestBody": {"overHeight": "1.5"}}',
            '{"specialRequestBody": {"openDala": "true"}}', '{"specialRequestBody": {"openDala": ""}}', "{broken"]
    demands = frame(spark, "demands", [{"id": i, "metadata": d, "created": created} for i, d in enumerate(docs)])
    points = [{"demand_id": 0, "created": created}] * 3 + [{"demand_id": 1, "created": created}] * 2
    flags = requests.special_request_flag(demands, frame(spark, "demand_addresses", points)).collect()
    assert {r.demand_id: r.sr_demand for r in flags} == {0: 1, 1: 0, 2: 0, 3: 1, 4: 1, 5: 0, 6: 0}


def test_rating_of_null_is_good(spark):
    row = spark.createDataFrame([(None,), (2,), (3,), (5,)], "r int").select(tickets.rating_label(F.col("r")).alias("c"))
    assert [r.c for r in row.collect()] == ["GOOD", "BAD", "MODERATE", "GOOD"]


@pytest.mark.parametrize("hot_rows", [5, 100_000])
@pytest.mark.parametrize("identical_rows", [False, True])
def test_fanout_join_equals_left_join(spark, hot_rows, identical_rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (4, "e")], "k int, l string")
    many = [(2, n % 9) for n in range(60)] + [(None, 7)] * 8 + [(3, 8)] * 8 + [(4, 1), (4, 1), (4, None)]
    right = spark.createDataFrame(many, "k int, r int")
    got = fanout_left_join(left, right, ["k"], identical_rows, hot_rows).select("k", "l", "r")
    plain = left.join(right, "k", "left").select("k", "l", "r")
    assert Counter(got.collect()) == Counter(plain.collect())


@pytest.mark.parametrize("order", ["spread", "equal", "null"])
def test_a_hot_key_is_dealt_evenly(spark, tmp_path, order):
    when = {"spread": F.timestamp_seconds("id"), "equal": F.timestamp_seconds(F.lit(0)), "null": F.lit(None)}[order]
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 10 == 0, "other").otherwise("hot").alias("k"), when.cast("timestamp_ntz").alias("t"), F.lit(1).alias("n")
    )
    path = str(tmp_path / "dealt")
    dealt_in_order(rows, ["k"], "t", ["n"], 8).write.parquet(path)
    dealt = spark.read.parquet(path)
    assert dealt.groupBy("_part").count().agg(F.max("count")).first()[0] < 2 * 20_000 / 8
    got = ordinal_within(dealt, ["k"], "t", ["n"], "o").groupBy("k").agg(F.min("o"), F.max("o"), F.count_distinct("o"))
    assert {tuple(r) for r in got.collect()} == {("hot", 1, 18_000, 18_000), ("other", 1, 2_000, 2_000)}


def test_salts_grow_with_the_key(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, l string")
    right = spark.range(30_000).select(F.when(F.col("id") < 3, 1).otherwise(2).alias("k"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("r"))
    got = fanout_left_join(left, right, ["k"], identical_rows=True, hot_rows=1_000)
    assert got.groupBy("k").count().orderBy("k").collect() == [(1, 3), (2, 29_997)]


def test_ordinals_of_a_hot_key(spark, tmp_path):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    data = [("hot" if n % 3 else f"k{n % 7}", start + dt.timedelta(minutes=rng.randrange(5_000)), n) for n in range(900)]
    data += [(None, None, 1_000), ("hot", None, 1_001), ("hot", None, 1_002)]
    path = str(tmp_path / "dealt")
    dealt_in_order(spark.createDataFrame(data, "k string, t timestamp_ntz, n int"), ["k"], "t", ["n"]).write.parquet(path)
    got = ordinal_within(spark.read.parquet(path), ["k"], "t", ["n"], "o")
    groups = defaultdict(list)
    for key, when, n in data:
        groups[key].append((when is not None, -(when - start).total_seconds() if when else 0, n))
    want = {n: i for rows in groups.values() for i, (_, _, n) in enumerate(sorted(rows), 1)}
    assert {r.n: r.o for r in got.collect()} == want


@pytest.mark.parametrize("slot", [3_600, 86_400, 10**7])
def test_offline_hours_against_all_pairs(spark, slot):
    rng = random.Random(5)
    base = 1_704_067_200
    spans, intervals = [], []
    for trip in range(40):
        times = sorted(base + rng.randrange(400_000) for _ in range(4))
        times = [None if rng.random() < 0.1 else t for t in times]
        spans.append((f"t{trip}", trip % 3, *times))
    edge = spans[0][2] or base
    for n in range(300):
        start = base + rng.randrange(400_000)
        intervals.append((n % 3, start, None if n % 31 == 0 else start + rng.randrange(60_000)))
    intervals.append((0, edge, edge))
    columns = "code string, vehicle_id bigint, going_to_load_epoch bigint, at_loading_epoch bigint, " \
        "in_transit_epoch bigint, at_unloading_epoch bigint"
    got = gps.offline_hours(
        spark.createDataFrame(spans, columns),
        spark.createDataFrame(intervals, "vehicle_id bigint, from_time bigint, to_time bigint"),
        slot,
    )

    def hours(code, vehicle, times, a, b):
        if times[a] is None or times[b] is None:
            return 0
        return sum(
            (end + 19_800) // 3_600 - (start + 19_800) // 3_600
            for v, start, end in intervals
            if v == vehicle and end is not None and times[a] <= start <= times[b] and times[a] <= end <= times[b]
        )

    want = {s[0]: tuple(hours(s[0], s[1], s[2:], i, i + 1) for i in range(3)) for s in spans}
    seen = {r.code: tuple(r)[1:] for r in got.collect()}
    assert {code: seen.get(code, (0, 0, 0)) for code in want} == want
    assert any(sum(v) for v in want.values())


def test_running_total_skips_gap_days_and_counts_daily_distinct(spark):
    rows = [("u", "2024-01-01"), ("v", "2024-01-01"), ("u", "2024-01-01"), ("u", "2024-01-04")]
    data = [{"user_code": u, "created_at": dt.datetime.fromisoformat(d), "deleted": "false"} for u, d in rows]
    got = growth.subscriptions_cumulative(frame(spark, "subscriptions", data)).orderBy("s_date").collect()
    assert [(str(r.s_date), r.cumulative_subscribed) for r in got] == [("2024-01-01", 2), ("2024-01-04", 3)]


def test_trip_balance_defaults(spark):
    reports = [
        {"demand_id": 1, "consignment_code": "C-1", "op_freight": 100.0, "tds_value": "", "vehicle_state": "TRIP_END"},
        {"demand_id": 2, "consignment_code": "C-2", "op_freight": 100.0, "tds_value": "0.1", "vehicle_state": "TRIP_END"},
    ]
    expenses = [{"consignment_id": "2", "amount": 5.0, "category": "CREDIT", "party_type": "OPERATOR", "deleted": "false"}]
    paid = [{"code": "C-2", "amount": 20.0, "otherparty": "OPERATOR", "status": "DONE"}]
    got = payments.trip_balance(
        frame(spark, "trip_reports", reports), frame(spark, "expenses", expenses), frame(spark, "bank_payments", paid)
    )
    assert {r.demand_id: r.trip_bal for r in got.collect()} == {1: None, 2: 75.0}


def test_issue_text_with_a_separator_counts_once(spark, sources):
    per_trip = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1), 1), ("b", dt.datetime(2024, 1, 1), None)],
        "code string, placement_time timestamp_ntz, total_tickets bigint",
    )
    day = tickets.trip_ticket_ratio_daily(per_trip).first()
    assert (day.trips, day.no_tickets_created_trips, day.trip_atleast_1_tickets, day.total_tickets_created) == (2, 1, 1, 1)
