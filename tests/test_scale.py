"""What the jobs do at scale: hash aggregates, one scan of a text, span cells, pushed lists, kept days, one commit."""

import datetime as dt
import math
import random
import re
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.bindings import APP_ID
from haulmetry.functions.codes import first_code, owner_of_first, scan_pattern, with_owner
from haulmetry.functions.rows import latest_number, latest_per_key, latest_time, pick_last, rows_of_listed
from haulmetry.operators import gps, milestones
from haulmetry.operators.cancellations import CANCEL_RULES
from haulmetry.operators.event_quality import COUNTERS, compliance_funnel, event_param_flatten, event_quality_counts
from haulmetry.plans.daily_counts import read_days, refresh_days
from haulmetry.plans.dashboard import BUCKET_KEYS, colocated
from haulmetry.sources.schemas import SCHEMAS
from haulmetry.sources.sinks import (
    OUTPUT_NAMES,
    ORDERED_BY,
    drop_old_runs,
    latest_first,
    publish,
    publish_together,
    published_run,
    read_published,
)
from haulmetry.sources.stage import Stage
from haulmetry.streaming.event_counts import read_event_stream, start_counting


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


# Latest rows


def test_latest_number_is_that_of_the_latest_row(spark):
    rng = random.Random(1)
    times = [None, dt.datetime(1, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 1), dt.datetime(9999, 12, 31)]
    numbers = [None, 0, 1, -1, 5, 2**63 - 1, -(2**63)]
    made = [(rng.randrange(300), rng.choice(times), rng.choice(numbers), rng.random() < 0.8) for _ in range(1500)]
    df = spark.createDataFrame(made, "k int, updated timestamp_ntz, n bigint, live boolean").repartition(5)
    updated, n = F.col("updated"), F.col("n")
    got = df.groupBy("k").agg(latest_number(updated, n).alias("a"), latest_number(updated, n, when=F.col("live")).alias("b"))
    want = df.groupBy("k").agg(pick_last(updated, "n")["n"].alias("a"), pick_last(updated, "n", when=F.col("live"))["n"].alias("b"))
    assert rows(got) == rows(want)
    assert "SortAggregate" in physical(want) and "SortAggregate" not in physical(got) and "HashAggregate" in physical(got)
    newest = df.groupBy("k").agg(latest_time(updated).alias("t"))
    assert rows(newest) == rows(df.groupBy("k").agg(pick_last(updated, "updated")["updated"].alias("t")))
    one = latest_per_key(df, ["k"], "updated", ["n"])
    assert rows(one) == rows(want.select("k", F.col("a").alias("n"))) and one.schema["n"].dataType == df.schema["n"].dataType


def test_the_state_log_is_combined_by_hash(spark, sources):
    assert "SortAggregate" not in physical(milestones.state_milestones(sources["consignment_states"]))


# Codes


def first_by_rule(text, codes):
    fits = [re.compile("".join("." if c == "_" else re.escape(c) for c in code.lower()), re.S) for code in codes]
    return None if text is None else next((k for k, fit in enumerate(fits) if fit.search(text.lower())), None)


@settings(max_examples=15, deadline=None)
@given(
    st.lists(st.text(alphabet="ab_", min_size=1, max_size=4), min_size=1, max_size=6),
    st.lists(st.one_of(st.none(), st.text(alphabet="aAb_-\n", max_size=9)), min_size=1, max_size=30),
)
def test_first_code_against_every_rule(spark, codes, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    got = dict(map(tuple, df.select("k", first_code(F.col("text"), codes)).collect()))
    assert got == {k: first_by_rule(t, codes) for k, t in enumerate(texts)}


def test_overlapping_codes_go_by_rule_order(spark):
    rules = [("b_c", "late"), ("a_b", "early"), ("x", "letter"), ("a_b_c_d", "long")]
    texts = ["a-b-c-d", "zz a_b", "A.B C", "x b\nc", "none", "", None, "axb", "a_b_c_d x"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    want = [None if (k := first_by_rule(t, [c for c, _ in rules])) is None else rules[k][1] for t in texts]
    assert [r[0] for r in df.select(owner_of_first(F.col("text"), rules)).collect()] == want
    owned = with_owner(df.union(df), "text", rules, "owner").collect()
    assert sorted(map(repr, owned)) == sorted(map(repr, [type(owned[0])(text=t, owner=o) for t, o in zip(texts, want, strict=True)] * 2))


def test_all_codes_share_one_pattern(spark):
    codes = [c for c, _ in CANCEL_RULES]
    pattern = re.compile(scan_pattern([c.lower() for c in codes]))
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice([rng.choice(codes), rng.choice(codes)[rng.randrange(9) :], " ", "é"]) for _ in range(4)).lower()
        found = [m[1] for m in pattern.finditer(text)]
        places = [next((k for k, c in enumerate(codes) if re.match("".join("." if x == "_" else x for x in c.lower()), t, re.S)), None) for t in found]
        assert min(places, default=None) == first_by_rule(text, codes)


def test_equal_remarks_are_read_once(spark):
    remarks = spark.createDataFrame([("x",), ("x",), (None,)], "remarks string")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    plan = with_owner(remarks, "remarks", CANCEL_RULES[:3], "owner")._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    # The text is searched in what the aggregate makes of each different text, and nowhere else.
    assert plan.count("regexp_extract_all") == 1 and plan.index("Aggregate [_text") < plan.index("regexp_extract_all")


# Spans


def test_spans_of_any_length_and_a_hot_vehicle(spark):
    day, rng = 86_400, random.Random(3)
    spans, intervals = [], []
    for k in range(60):
        start = rng.randrange(0, 400 * day)
        length = rng.choice([0, 60, day, 15 * day, 17 * day, 300 * day, 30 * 365 * day])
        spans.append((f"t{k}", "v", rng.choice([1, 1, 2]), start, start + length // 3, start + length // 2, start + length))
    spans.append(("bad", "v", 1, -(10**12), 0, 10**9, 4 * 10**15))
    spans.append(("worse", "v", 1, -(2**61), None, None, 2**61))
    for _ in range(400):
        at = rng.randrange(0, 12_000 * day) if rng.random() < 0.3 else rng.randrange(0, 400 * day)
        intervals.append((rng.choice([1, 1, 1, 2]), at, None if rng.random() < 0.1 else at + rng.randrange(0, 20 * day)))
    times = [name for name in gps._TIMES]
    left = spark.createDataFrame(spans, "code string, vehicle_number string, vehicle_id bigint, " + ", ".join(f"{t} bigint" for t in times))
    right = spark.createDataFrame(intervals, "vehicle_id bigint, from_time bigint, to_time bigint")
    got = {r.code: tuple(r)[1:] for r in gps.offline_hours(left, right).collect()}

    def hours(a, b):
        return (b + 19_800) // 3600 - (a + 19_800) // 3600

    want = {}
    for code, _, vehicle, *ts in spans:
        known = [t for t in ts if t is not None]
        met = [(a, b) for v, a, b in intervals if v == vehicle and b is not None and min(known) <= a <= max(known)]
        if met:
            sums = []
            for x, y in zip(ts, ts[1:], strict=False):
                inside = [hours(a, b) for a, b in met if x is not None and y is not None and x <= a <= y and x <= b <= y]
                sums.append(sum(inside))
            want[code] = tuple(sums)
    assert got == want
    widths = left.select(gps.fitting_width(F.least(*times), F.greatest(*times), day).alias("w")).distinct().collect()
    assert {0, 1} < {r.w for r in widths} and max(r.w for r in widths) < gps._WIDTHS


# Value lists


def test_a_list_of_values_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "history")
    history = spark.range(40_000).select(F.format_string("1.%d.0", F.col("id") % 400).alias("app_version"), "id")
    history.repartitionByRange(8, "app_version").sortWithinPartitions("app_version").write.option("parquet.block.size", 64_000).parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "20000")
    df = spark.read.parquet(path)
    values = spark.createDataFrame([("1.7.0",), ("1.7.0",), ("1.8.0",), (None,)], "app_version string")
    got = rows_of_listed(df, "app_version", values)
    assert "In(app_version, [1.7.0,1.8.0])" in physical(got)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    want = rows(df.join(values, "app_version", "left_semi"))
    assert rows(got) == want and len(want) == 200
    got.collect()
    scan = got._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() < 40_000
    assert rows(rows_of_listed(df, "app_version", values, most=1)) == want
    assert "left_semi" in physical(rows_of_listed(df, "app_version", values, most=1)).lower().replace("leftsemi", "left_semi")
    assert rows_of_listed(df, "app_version", values.limit(0)).count() == 0


# One commit


def _outputs(spark, value):
    return {name: spark.range(50).select(F.lit(dt.date(2024, 1, value)).alias(column), "id") for name, column in ORDERED_BY.items()}


def test_a_failed_run_leaves_the_old_outputs(spark, tmp_path):
    root, first, second = str(tmp_path / "out"), dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
    assert published_run(spark, root) is None
    assert tuple(publish_together(_outputs(spark, 1), root, first)) == OUTPUT_NAMES
    broken = _outputs(spark, 2)
    broken["avg_quotes"] = broken["avg_quotes"].where(F.raise_error(F.lit("gone")).isNull())
    with pytest.raises(Exception, match="gone"):
        publish_together(broken, root, second)
    assert len(list((Path(root) / "runs").iterdir())) == 2
    for name, column in ORDERED_BY.items():
        kept = read_published(spark, root, name)
        assert [tuple(r) for r in kept.select(column, "refreshed_at").distinct().collect()] == [(dt.date(2024, 1, 1), first)]
    publish_together(_outputs(spark, 3), root, second)
    assert {read_published(spark, root, n).first()[c] for n, c in ORDERED_BY.items()} == {dt.date(2024, 1, 3)}
    assert len(drop_old_runs(spark, root, keep=1)) == 2 and read_published(spark, root, "tickets").count() == 50
    with pytest.raises(ValueError, match="not published"):
        read_published(spark, root, "other")
    with pytest.raises(ValueError, match="unknown outputs"):
        publish_together({"other": spark.range(1)}, root, first)


def test_outputs_are_sorted_over_many_files(spark, tmp_path):
    rng = random.Random(4)
    days = [None, *[dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(20)]]
    made = [(days[7] if rng.random() < 0.4 else rng.choice(days), k) for k in range(5000)]
    df = spark.createDataFrame(made, "day date, id int").repartition(6)
    path = publish(df, str(tmp_path), "Call_fo", dt.datetime(2024, 2, 1), latest_first("Call_fo"))
    files = sorted(Path(path).glob("part-*.parquet"))
    read = [[r.day for r in spark.read.parquet(str(f)).collect()] for f in files]
    found = [d for part in read for d in part]
    assert found == sorted((d for d, _ in made), key=lambda d: dt.date(9999, 1, 1) if d is None else d, reverse=True)
    # The frequent day lies in several files, and no file holds a large share.
    assert sum(days[7] in part for part in read) >= 3 and max(map(len, read)) < 0.3 * len(made)


# Co-located tables


def test_tables_in_buckets_join_without_a_shuffle(spark, sources, tmp_path):
    tables = {name: sources[name] for name in SCHEMAS if name not in ("app_events", "release_events")}
    stage = Stage(spark, str(tmp_path / "stage"))
    listed = len(spark.catalog.listTables())
    near = colocated(tables, stage, 4)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:

        def folded(t):
            return t["consignments"].select("code", "demand_id").join(milestones.state_epochs(t["consignment_states"]), "code")

        def fields(t):
            return t["tickets"].select(F.col("id").alias("ticket_id"), "ticket_code").join(t["ticket_field_values"].select("ticket_id", "string_value"), "ticket_id")

        for job in (folded, fields):
            assert "Exchange" not in physical(job(near)) and "Exchange" in physical(job(tables))
            assert rows(job(near)) == rows(job(tables))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert set(BUCKET_KEYS) <= set(near)
    stage.clear()
    assert not list((tmp_path / "stage").iterdir()) and len(spark.catalog.listTables()) == listed


def test_a_hot_key_is_not_put_in_one_bucket(spark, tmp_path):
    stage = Stage(spark, str(tmp_path))
    hot = spark.range(9_000).select(F.when(F.col("id") < 4_000, 0).otherwise(F.col("id")).alias("code"), "id")
    unset = hot.withColumn("code", F.when(F.col("code") > 0, F.col("code")))
    for df in (hot, unset):
        kept = stage.keep_bucketed(df, "code", 8)
        assert "Exchange" in physical(kept.groupBy("code").count()) and kept.count() == 9_000
    even = stage.keep_bucketed(hot.where("id >= 4000"), "code", 8)
    assert "Exchange" not in physical(even.groupBy("code").count())
    stage.clear()


# Kept days and the stream


@pytest.fixture(scope="module")
def events(sources):
    return sources["app_events"].where("event_date between '20240101' and '20240112'").persist()


def _counted(events, start, end):
    return rows(event_quality_counts(event_param_flatten(events, [APP_ID], start, end)))


def test_overlapping_runs_equal_one_run(spark, events, tmp_path):
    path = str(tmp_path / "days")
    refresh_days(events, [APP_ID], "20240101", "20240106", path)
    before = {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet") if re.search(r"2024010[1-4]", str(f))}
    kept = refresh_days(events, [APP_ID], "20240105", "20240110", path)
    assert rows(kept) == _counted(events, "20240105", "20240110")
    assert rows(read_days(spark, path, "20240101", "20240110")) == _counted(events, "20240101", "20240110")
    assert before == {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet") if re.search(r"2024010[1-4]", str(f))}
    # A day whose events are gone is replaced as well, and a repeated run changes nothing.
    fewer = events.where("event_date != '20240110'")
    for _ in range(2):
        refresh_days(fewer, [APP_ID], "20240109", "20240112", path)
        assert rows(read_days(spark, path, "20240101", "20240112")) == _counted(fewer, "20240101", "20240112")


def test_a_stream_with_late_rows_and_a_restart_equals_the_batch(spark, events, tmp_path):
    log, path, progress = (str(tmp_path / name) for name in ("log", "days", "progress"))
    batches = ["event_date < '20240105'", "event_date between '20240105' and '20240107'", "event_date > '20240107'"]
    late = events.where("event_date = '20240107'").withColumn("event_name", F.lit("v1_late"))
    everything = events.union(late)

    def run():
        stream = read_event_stream(spark, log, files_per_batch=1)
        start_counting(stream, [APP_ID], "20240101", "20240112", path, progress, lateness="6 days").awaitTermination()
        return rows(read_days(spark, path, "20240101", "20240112"))

    for k, batch in enumerate(batches[:2]):
        events.where(batch).coalesce(1).write.mode("append").parquet(log)
        assert run() == _counted(events.where(" or ".join(f"({b})" for b in batches[: k + 1])), "20240101", "20240112")
    events.where(batches[2]).coalesce(2).write.mode("append").parquet(log)
    run()
    late.coalesce(1).write.mode("append").parquet(log)
    assert run() == _counted(everything, "20240101", "20240112")
    assert run() == _counted(everything, "20240101", "20240112")  # nothing new: nothing changes
    # Later than the watermark allows: not counted, until the days are counted anew.
    too_late = events.where("event_date = '20240101'").withColumn("event_name", F.lit("v1_too_late"))
    too_late.coalesce(1).write.mode("append").parquet(log)
    assert run() == _counted(everything, "20240101", "20240112")
    refresh_days(spark.read.parquet(log), [APP_ID], "20240101", "20240102", path)
    assert rows(read_days(spark, path, "20240101", "20240112")) == _counted(everything.union(too_late), "20240101", "20240112")


# Two grains in one pass


def test_funnel_reads_its_counts_once(spark, tmp_path):
    rng = random.Random(3)
    made = []
    for _ in range(400):
        total = rng.randrange(1, 200)
        passed = [rng.choice([total, total, 0, None, total - 1]) for _ in COUNTERS]
        made.append((rng.choice([None, "a", "b", "c", "d"]), rng.choice([None, "app_latest_0", "app_latest_1", "overall"]), total, *passed))
    schema = "combined_event string, row_number string, total_rows bigint, " + ", ".join(f"{c} bigint" for c in COUNTERS)
    path = str(tmp_path / "tagged")
    spark.createDataFrame(made, schema).repartition(5).write.parquet(path)
    tagged = spark.read.parquet(path)

    def passing(rows):
        """Signatures, and for each counter those that miss less than one percent, rounded half up to a tenth."""
        sums = {}
        for event, _, total, *passed in rows:
            kept = sums.setdefault(event, [0] + [None] * len(COUNTERS))
            kept[0] += total
            for k, n in enumerate(passed, 1):
                kept[k] = kept[k] if n is None else n + (kept[k] or 0)
        miss = lambda s, k: None if s[k] is None else math.floor((s[0] - s[k]) / s[0] * 1000 + 0.5) / 10
        return [len(sums)] + [sum(not (miss(s, k) is not None and miss(s, k) >= 1) for s in sums.values()) for k in range(1, len(COUNTERS) + 1)]

    funnel = compliance_funnel(tagged)
    # The flag of all rows and a version of that name stay two rows.
    want = [("overall", *passing(made))]
    want += [(v, *passing([r for r in made if r[1] == v])) for v in ("app_latest_0", "app_latest_1", "overall")]
    assert sorted(map(tuple, funnel.select("flag", "total_events", *COUNTERS).collect())) == sorted(want)
    plan = physical(funnel)
    assert plan.count("Scan parquet") == 1 and plan.count("Expand") == 1 and "Union" not in plan
    assert compliance_funnel(tagged.limit(0)).count() == 0
