"""Hours a trip's tracking device was offline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetry.functions.clock import epoch_boundary_diff, local_from_epoch
from haulmetry.functions.ratio import ratio
from haulmetry.functions.rows import Keep, as_is
from haulmetry.operators.milestones import state_epochs

# Fixed value: the vehicle state that is reported on.
LIVE = "LIVE"
SEGMENT_STATES = ("GOING_TO_LOAD", "AT_LOADING", "IN_TRANSIT", "AT_UNLOADING")
_TIMES = ("going_to_load_epoch", "at_loading_epoch", "in_transit_epoch", "at_unloading_epoch")
_SEGMENTS = (
    ("gtl_to_loading_time", _TIMES[0], _TIMES[1]),
    ("loading_to_transit_time", _TIMES[1], _TIMES[2]),
    ("transit_to_unloading_time", _TIMES[2], _TIMES[3]),
)


def _hours_inside(start: str, end: str) -> Column:
    """Hours of an interval that lies fully inside one trip segment, both ends included."""
    inside = F.col("from_time").between(F.col(start), F.col(end)) & F.col("to_time").between(F.col(start), F.col(end))
    hours = epoch_boundary_diff("hour", F.col("from_time"), F.col("to_time"))
    return F.sum(F.when(inside, hours).otherwise(F.lit(0).cast("bigint")))


#: A span is listed under the cells of one width only, the first of which it fills fewer than so many;
#: each width is that many times the one before. At most 17 cells a span, and 12 widths for any epoch.
_FAN, _WIDTHS = 16, 12


def _widths(slot_seconds: int) -> list[int]:
    return [w for w in (slot_seconds * _FAN**k for k in range(_WIDTHS)) if w < 2**62]


def _cell(seconds: Column, width: Column) -> Column:
    """Number of the cell that holds a time; cells are counted from the epoch."""
    down = F.floor(seconds / width)
    # Dividing goes through doubles: set right what rounding did to the largest epochs.
    exact = (seconds - F.pmod(seconds, width)) / width
    return F.when(F.abs(seconds) < 2**52, down).otherwise(exact).cast("bigint")


def fitting_width(first: Column, last: Column, slot_seconds: int) -> Column:
    """Number of the cell width that fits a span's length."""
    length = last.cast("double") - first.cast("double")
    edges = F.array(*[F.lit(float(w * _FAN)) for w in _widths(slot_seconds)[:-1]])
    return F.size(F.filter(edges, lambda w: w <= length))


def offline_hours(spans: DataFrame, intervals: DataFrame, slot_seconds: int = 86_400) -> DataFrame:
    """Offline hours per trip and segment.

    Containment goes by an index of cells of growing width, a day at first: a trip is listed under the
    cells of the one width that fits its length, so one that seems to last for decades costs no more
    rows than one of days. An interval is listed under the cell it starts in, once for each width that
    its vehicle's trips use, which is nearly always the first alone. Each pair meets at most once, and
    a vehicle with a large share of the intervals is spread over its cells.
    """
    # least and greatest skip NULL: a span covers whatever milestones are known.
    first, last = F.least(*_TIMES), F.greatest(*_TIMES)
    sized = spans.where(last.isNotNull()).withColumn("width", fitting_width(first, last, slot_seconds))
    widths = F.array(*[F.lit(w).cast("bigint") for w in _widths(slot_seconds)])
    width = F.get(widths, F.col("width"))
    listed = sized.withColumn("cell", F.explode(F.sequence(_cell(first, width), _cell(last, width))))
    # No filter before the aggregate and no fewer columns: both readings of the trips share their exchanges.
    is_long = F.col("code").isNotNull() & (F.col("width") > 0)
    long = sized.groupBy("vehicle_id").agg(F.collect_set(F.when(is_long, F.col("width"))).alias("wide"))
    long = long.where(F.size("wide") > 0)
    used = F.concat(F.array(F.lit(0)), F.coalesce("wide", F.array().cast("array<int>")))
    started = (
        intervals.where(F.col("to_time").isNotNull() & F.col("from_time").isNotNull())
        .select("vehicle_id", "from_time", "to_time")
        .join(long, "vehicle_id", "left")
        .withColumn("width", F.explode(used))
        .withColumn("cell", _cell(F.col("from_time"), width))
        .drop("wide")
    )
    met = listed.join(started, ["vehicle_id", "width", "cell"], "inner").where(F.col("from_time").between(first, last))
    return met.groupBy("code").agg(*[_hours_inside(a, b).alias(name) for name, a, b in _SEGMENTS])


def gps_offline(
    consignments: DataFrame,
    vehicle_details: DataFrame,
    vehicles: DataFrame,
    device_history: DataFrame,
    states: DataFrame,
    slot_seconds: int = 86_400,
    keep: Keep = as_is,
) -> DataFrame:
    """Per trip of a live vehicle: offline hours by segment, in total, and as a share of the journey.

    ``keep`` is given the trips, which are read three times.
    """
    live = vehicle_details.where(F.col("vehicle_state") == LIVE).select(
        "vehicle_number", "device_name", "device_family", "hardware_type", "sim_network"
    )
    trips = keep(
        consignments.select("code", "vehicle_number", "operator_code")
        .join(state_epochs(states, SEGMENT_STATES), "code", "left")
        .join(live, "vehicle_number", "inner")
        .distinct()
    )
    ids = vehicles.select(F.col("id").alias("vehicle_id"), "vehicle_number")
    spans = trips.select("code", "vehicle_number", *_TIMES).distinct().join(ids, "vehicle_number", "inner")
    hours = offline_hours(spans, device_history, slot_seconds)
    segments = {name: F.coalesce(F.col(name), F.lit(0).cast("bigint")) for name, _, _ in _SEGMENTS}
    total = F.col("gtl_to_loading_time") + F.col("transit_to_unloading_time")
    return (
        trips.join(hours, "code", "left")
        .withColumns(segments)
        .withColumns(
            {
                "trnst_time": local_from_epoch(F.col("in_transit_epoch")),
                "trip_journey": epoch_boundary_diff("hour", F.col(_TIMES[0]), F.col(_TIMES[3])),
                "transit_journey": epoch_boundary_diff("hour", F.col(_TIMES[2]), F.col(_TIMES[3])),
                "total_offline_time": total,
            }
        )
        .withColumn("offline_share", ratio(F.col("total_offline_time"), F.col("trip_journey")))
        .select(
            "code",
            "vehicle_number",
            "operator_code",
            "trnst_time",
            "trip_journey",
            *[name for name, _, _ in _SEGMENTS],
            "total_offline_time",
            "offline_share",
            "device_name",
            "device_family",
            "hardware_type",
            "sim_network",
            "transit_journey",
        )
    )
