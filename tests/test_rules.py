"""Semantic rules that differ between engines, on rows made by hand."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from haulmetry.functions import clock, ratio, rows, text
from haulmetry.operators import app_versions, event_issues, event_quality


def one(spark, column, **values):
    frame = spark.range(1)
    for name, value in values.items():
        frame = frame.withColumn(name, value if not isinstance(value, (str, int, float)) else F.lit(value))
    return frame.select(column.alias("x")).first().x


def ts(value):
    return F.lit(value).cast("timestamp_ntz")


@pytest.mark.parametrize(
    ("unit", "start", "end", "crossed"),
    [
        ("hour", "2024-01-01 10:59:59", "2024-01-01 11:01:00", 1),
        ("hour", "2024-01-01 10:00:00", "2024-01-01 10:59:59.9", 0),
        ("minute", "2024-01-01 10:00:59.9", "2024-01-01 10:01:00", 1),
        ("minute", "2024-01-01 10:01:00", "2024-01-01 10:00:59.9", -1),
        ("day", "2024-01-01 23:59:00", "2024-01-02 00:01:00", 1),
        ("hour", "1969-12-31 23:59:59.5", "1970-01-01 00:00:00", 1),
    ],
)
def test_difference_counts_boundaries(spark, unit, start, end, crossed):
    assert one(spark, clock.boundary_diff(unit, ts(start), ts(end))) == crossed


def test_epoch_difference_uses_the_local_clock(spark):
    # 05:29 and 05:31 local are in one hour in UTC terms of 23:59 and 00:01, and in one local hour.
    start = int(dt.datetime(2024, 1, 1, 23, 59, tzinfo=dt.UTC).timestamp())
    assert one(spark, clock.epoch_boundary_diff("hour", F.lit(start), F.lit(start + 120))) == 0
    half = int(dt.datetime(2024, 1, 1, 0, 29, tzinfo=dt.UTC).timestamp())
    assert one(spark, clock.epoch_boundary_diff("hour", F.lit(half), F.lit(half + 120))) == 1


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    columns = [
        clock.local_from_epoch(F.lit(1_704_067_200)),
        clock.boundary_diff("hour", ts("2024-03-10 01:59:00"), ts("2024-03-10 03:01:00")),
        clock.week_range_label(ts("2024-03-10 02:30:00")),
        clock.month_label(ts("2024-03-10 02:30:00")),
        clock.epoch_micros(ts("2024-03-10 02:30:00.000001")),
    ]
    seen = set()
    try:
        for name in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            seen.add(tuple(spark.range(1).select(*columns).first()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert seen == {(dt.datetime(2024, 1, 1, 5, 30), 2, "04-Mar-24 - 10-Mar-24", "Mar'24", 1_710_037_800_000_001)}


@pytest.mark.parametrize(
    ("doc", "value"),
    [
        (None, None),
        ("", None),
        ('{"ptl": ', None),
        ("{}", ""),
        ('{"ptl": "true"}', "true"),
        ('{"ptl": true}', "true"),
        ('{"other": 1}', ""),
    ],
)
def test_missing_json_key_is_blank_and_bad_document_is_null(spark, doc, value):
    assert one(spark, text.json_text(F.lit(doc).cast("string"), "ptl")) == value


def test_json_array_items(spark):
    doc = F.lit('{"items": [{"name": "box"}, {"unit": "kg"}]}')
    parsed = text.json_document(doc, "items array<struct<name: string, unit: string, quantity: string>>")
    assert one(spark, text.json_item(parsed, "items", 1, "unit")) == "kg"
    assert one(spark, text.json_item(parsed, "items", 2, "quantity")) == ""
    assert one(spark, text.json_item(text.json_document(F.lit("{bad"), "items array<struct<unit: string>>"), "items", 0, "unit")) is None


def test_text_numbers_never_raise(spark):
    for value, want in (("2.5", 2.5), ("", None), ("abc", None), (None, None)):
        assert one(spark, text.number(F.lit(value).cast("string"))) == want


def test_version_order_is_numeric(spark):
    versions = spark.createDataFrame([("1.9.0",), ("1.10.0",), ("1.2.0",), ("",)], "v string")
    assert [r.v for r in versions.orderBy(text.version_key(F.col("v"))).collect()] == ["", "1.2.0", "1.9.0", "1.10.0"]


def test_zero_denominator_is_null(spark):
    assert one(spark, ratio.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, ratio.percent(F.lit(1), F.lit(3), 2)) == 33.33


def test_null_order_is_latest_and_last_of_the_earliest(spark):
    data = spark.createDataFrame(
        [("a", None, 1), ("a", 5, 2), ("b", 3, 3), ("b", 3, 4), ("b", 1, 9)], "k string, o int, v int"
    )
    assert set(rows.latest_per_key(data, ["k"], "o", ["v"]).collect()) == {Row(k="a", v=1), Row(k="b", v=4)}
    assert set(rows.earliest_per_key(data, ["k"], "o", ["v"]).collect()) == {Row(k="a", v=2), Row(k="b", v=9)}


def test_first_value_of_a_repeated_key(spark):
    kind = "array<struct<key: string, value: struct<string_value: string>>>"
    data = spark.createDataFrame(
        [([("k", ("1",)), ("k", ("2",))],), ([("k", (None,))],), ([("z", ("1",))],), ([],), (None,)], f"p {kind}"
    )
    assert [r.x for r in data.select(text.key_lookup(F.col("p"), "k").alias("x")).collect()] == ["1", None, None, None, None]


def _counts(spark, rows_):
    keys = "event_platform, app_version, event_name, event_action, event_category, screen_name, target_product".split(", ")
    counters = [c for c in event_quality.COUNTERS]
    data = []
    for row in rows_:
        filled = {k: row.get(k) for k in keys}
        filled["total_rows"] = row["total_rows"]
        for c in counters:
            filled[c] = row.get(c, row["total_rows"])
        data.append(filled)
    schema = ", ".join([*(f"{k} string" for k in keys), "total_rows bigint", *(f"{c} bigint" for c in counters)])
    return spark.createDataFrame(data, schema)


def test_version_list(spark):
    sizes = {"": 500, "1.2.0": 1, "1.9.0": 90, "1.10.0": 5, "1.1.0 debug": 999, **{f"0.{n}.0": 100 + n for n in range(12)}}
    counts = _counts(
        spark, [{"event_platform": "android", "app_version": v, "total_rows": n} for v, n in sizes.items()]
        + [{"event_platform": "ios", "app_version": "9.9.9", "total_rows": 10_000}]
    )
    listed = {r.app_version: r for r in app_versions.app_version_rank(counts).collect()}
    # Newest by number, then the nine largest; the blank version is the lowest and left out.
    assert set(listed) == {"1.10.0", *[f"0.{n}.0" for n in range(3, 12)]}
    assert listed["1.10.0"].row_number == "app_latest_0"
    assert listed["0.11.0"].row_number == "app_latest_1"
    pinned = app_versions.app_version_rank(counts, latest_version="1.2.0").collect()
    assert {"1.2.0"} | {f"0.{n}.0" for n in range(3, 12)} == {r.app_version for r in pinned}
    kept = app_versions.app_version_rank(counts, drop_lowest=False).collect()
    assert "" in {r.app_version for r in kept} and len(kept) == 10
    as_text = app_versions.app_version_rank(counts, numeric_order=False).collect()
    assert "1.9.0" in {r.app_version for r in as_text}


def test_version_list_edge_sizes(spark):
    single = _counts(spark, [{"event_platform": "android", "app_version": "1.0", "total_rows": 1}])
    assert app_versions.app_version_rank(single).count() == 0
    assert app_versions.app_version_rank(single, drop_lowest=False).count() == 1
    missing = app_versions.app_version_rank(single, latest_version="7.7", drop_lowest=False).collect()
    assert [r.app_version for r in missing] == ["1.0"]


def test_signature_spells_missing_parts(spark):
    counts = _counts(
        spark,
        [
            {"event_name": "v1_x", "event_action": None, "total_rows": 1},
            {"event_name": "v1_x", "event_action": "zoom", "event_category": "c", "screen_name": "s", "total_rows": 1},
            {"event_name": "v1_x", "event_action": "Click", "total_rows": 1},
        ],
    )
    texts = {r.combined_event for r in event_quality.event_signature(counts).collect()}
    assert texts == {"v1_xaNoneNone", "v1_xacs", "v1_xClickNoneNone"}


def test_funnel_limit_is_one_percent(spark):
    tagged = _counts(
        spark,
        [
            {"event_name": name, "event_action": "click", "total_rows": 1_000, "event_category_fill": filled}
            for name, filled in (("just_under", 991), ("at_limit", 990))
        ],
    ).withColumn("row_number", F.lit(None).cast("string"))
    funnel = event_quality.compliance_funnel(event_quality.event_signature(tagged)).first()
    assert (funnel.flag, funnel.total_events, funnel.event_category_fill) == ("overall", 2, 1)


def test_issue_rules_and_newest_version(spark):
    base = {
        "event_platform": "android",
        "target_product": "p",
        "event_name": "n",
        "event_action": "click",
        "event_category": "c",
        "screen_name": "s",
        "total_rows": 100,
    }
    rows_ = [
        {**base, "app_version": "2", "user_code_fill": 70},
        {**base, "app_version": "1", "entity_fill": 95, "entity_key": 10},
        {**base, "app_version": "1", "event_name": "clean"},
        {**base, "app_version": "1", "event_name": "blank", "screen_name": None, "screen_name_fill": 0, "screen_name_lower": 0},
    ]
    labels = spark.createDataFrame([("2", "app_latest_0"), ("1", "app_latest_1")], "app_version string, row_number string")
    tagged = _counts(spark, rows_).join(labels, "app_version")
    issues = event_issues.issue_classifier(tagged)
    texts = {(r.event_name, r.row_number): r.issue_type for r in issues.collect()}
    assert texts == {
        ("n", "app_latest_0"): "user_code missing",
        ("n", "app_latest_1"): "entity key value is not in right format",
        ("clean", "app_latest_1"): "",
    }
    every = event_issues.issue_classifier(tagged, drop_null_keys=False)
    assert "screen name missing" in {r.issue_type for r in every.collect()}
    newest = event_issues.issue_export(event_issues.issue_latest_version(issues, labels)).collect()
    assert [(r.app_version, r.event_name, r.issue_type) for r in newest] == [("2", "n", "user_code missing")]


def test_latest_by_release_date(spark):
    counts = spark.createDataFrame(
        [(f"1.{n}.0", "android", 10 + n) for n in range(5)] + [(None, "android", 99), ("1.1.0 debug", "android", 99)],
        "app_version string, event_platform string, total_rows bigint",
    )
    released = spark.createDataFrame([("1.4.0", "2024-01-01"), ("1.2.0", "2024-02-01")], "app_version string, release_date string")
    for dates, dropped_first in ((None, "1.4.0"), (released, "1.2.0")):
        ranked = app_versions.app_version_rank(counts, others=0, released=dates)
        assert [r.app_version for r in ranked.collect()] == [dropped_first]


def test_rows_without_a_version_are_no_debug_build(spark):
    counts = spark.createDataFrame([("1.0", "android"), (None, "android"), ("1.1.0 debug", "android")], "app_version string, event_platform string")
    assert {r.app_version for r in app_versions.platform_rows(counts).collect()} == {"1.0", None}
