"""Trip milestones and the delay buckets derived from them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetry.functions.clock import epoch_boundary_diff, local_from_epoch
from haulmetry.functions.rows import latest_number
from haulmetry.functions.text import json_document, json_field, number

# Trip states, bucket names and limits, assumed daily distances, report start.
STATES = ("GOING_TO_LOAD", "AT_LOADING", "IN_TRANSIT", "AT_UNLOADING", "TRIP_END")
LOADING_BUCKETS = ((1, "ontime"), (120, "delay_2hr"), (240, "delay_2hr_to_4hr"))
LOADING_LAST = "delay_4hours+"
TRANSIT_BUCKETS = ((0, "ontime"), (24, "dely_undr_24"), (48, "dely_undr_48"))
TRANSIT_LAST = "dely_abv_48"
SHIPPER_KM_PER_DAY = 300
OPERATOR_KM_PER_DAY = 400
TRIPS_SINCE = "2024-01-01"

TRIP_METADATA = (
    "ptl string, appLoadingTime string, estimatedRouteDistance string, shipperTATinHrs string, "
    "operatorTATinHrs string"
)


#: Rows of the state log that count: those marked as live, or all but those marked as deleted. In a
#: folded log the states that a trip has are bits, and the epochs of the second kind have a prefix.
LIVE, NOT_DELETED = "live", "not_deleted"
_MARKS = {LIVE: ("seen", ""), NOT_DELETED: ("seen_not_deleted", "not_deleted_")}


def _counts(mark: str) -> Column:
    return F.col("deleted") == "false" if mark == LIVE else F.col("deleted") != "true"


def _epoch_name(state: str) -> str:
    return f"{state.lower()}_epoch"


def folded_states(states: DataFrame) -> DataFrame:
    """The state log folded to a row for each consignment: ``state_epochs`` takes any state and mark from it.

    One pass over the log. Write the result where several jobs take their times from it.
    """
    bit = F.element_at(F.create_map(*[F.lit(x) for k, s in enumerate(STATES) for x in (s, 1 << k)]), F.col("state"))
    updated, time = F.col("updated"), F.col("time")
    columns = []
    for mark, (seen, prefix) in _MARKS.items():
        columns.append(F.coalesce(F.bit_or(F.when(_counts(mark), bit)), F.lit(0)).alias(seen))
        # The only one that a job takes of rows that are not marked is the end of the trip.
        for s in STATES if mark == LIVE else ("TRIP_END",):
            latest = latest_number(updated, time, when=_counts(mark) & (F.col("state") == s))
            columns.append(latest.alias(prefix + _epoch_name(s)))
    kept = states.where((_counts(LIVE) | _counts(NOT_DELETED)) & F.col("state").isin(*STATES))
    return kept.groupBy(F.col("consignment_code").alias("code")).agg(*columns)


def state_epochs(states: DataFrame, wanted: Iterable[str] = STATES, mark: str = LIVE) -> DataFrame:
    """Per consignment, the epoch second of its latest row in each state, as ``<state>_epoch``.

    One pass over the state log, combined before the shuffle; every job takes its times from here.
    ``states`` may be what ``folded_states`` made of the log, which is not folded again.
    """
    wanted = tuple(wanted)
    if "state" not in states.columns:
        seen, prefix = _MARKS[mark]
        bits = sum(1 << STATES.index(s) for s in wanted)
        had = states.where(F.col(seen).bitwiseAND(F.lit(bits)) != 0)
        return had.select("code", *[F.col(prefix + _epoch_name(s)).alias(_epoch_name(s)) for s in wanted])
    kept = states.where(_counts(mark) & F.col("state").isin(*wanted))
    updated, time = F.col("updated"), F.col("time")
    return kept.groupBy(F.col("consignment_code").alias("code")).agg(
        *[latest_number(updated, time, when=F.col("state") == s).alias(_epoch_name(s)) for s in wanted]
    )


def state_milestones(states: DataFrame, wanted: Iterable[str] = STATES) -> DataFrame:
    """Per consignment, the local time of its latest row in each state, as ``<state>_time``."""
    wanted = tuple(wanted)
    epochs = state_epochs(states, wanted)
    return epochs.select(
        "code", *[local_from_epoch(F.col(f"{s.lower()}_epoch")).alias(f"{s.lower()}_time") for s in wanted]
    )


def loading_bucket(minutes: Column) -> Column:
    """Bucket of a loading delay; a missing delay falls into the last bucket."""
    bucket = F.lit(LOADING_LAST)
    for limit, name in reversed(LOADING_BUCKETS):
        bucket = F.when(minutes <= limit, F.lit(name)).otherwise(bucket)
    return bucket


def transit_bucket(hours: Column) -> Column:
    """Bucket of a transit overrun; a missing overrun has none."""
    last_limit = TRANSIT_BUCKETS[-1][0]
    bucket = F.when(hours > last_limit, F.lit(TRANSIT_LAST))
    for limit, name in reversed(TRANSIT_BUCKETS):
        bucket = F.when(hours <= limit, F.lit(name)).otherwise(bucket)
    return bucket


def trip_times(consignments: DataFrame, demands: DataFrame, states: DataFrame, since: str = TRIPS_SINCE) -> DataFrame:
    """Ended trips with their milestones and the promises parsed from their demand."""
    ended = state_epochs(states).where(
        local_from_epoch(F.col("trip_end_epoch")) >= F.lit(since).cast("timestamp_ntz")
    )
    promised = demands.select(
        F.col("id").alias("demand_id"),
        "consigner_user_code",
        json_document(F.col("metadata"), TRIP_METADATA).alias("doc"),
    )
    return consignments.select("code", "demand_id").join(ended, "code", "inner").join(promised, "demand_id", "left")


def _loading_delay() -> Column:
    expected = number(json_field(F.col("doc"), "appLoadingTime"))
    return epoch_boundary_diff("minute", expected, F.col("at_loading_epoch"))


def _overrun(promise: str, km_per_day: int) -> Column:
    doc = F.col("doc")
    journey = epoch_boundary_diff("hour", F.col("in_transit_epoch"), F.col("at_unloading_epoch"))
    distance = number(json_field(doc, "estimatedRouteDistance"))
    by_distance = F.when(distance > 0, F.floor(distance)) / F.lit(float(km_per_day)) * F.lit(24.0)
    promised = json_field(doc, promise)
    hours = F.when(promised != "", number(promised)).otherwise(by_distance)
    return journey.cast("double") - hours


def loading_delay_bucket(times: DataFrame) -> DataFrame:
    """Distinct loading delays (minutes from expected to actual) per demand, from ``trip_times``."""
    delays = times.select("demand_id", _loading_delay().alias("g_delay")).distinct()
    return delays.withColumn("gtl_delay", loading_bucket(F.col("g_delay")))


def transit_delay_bucket(times: DataFrame) -> DataFrame:
    """Distinct transit overruns against both promises per demand, from ``trip_times``."""
    overruns = times.select(
        "demand_id",
        _overrun("shipperTATinHrs", SHIPPER_KM_PER_DAY).alias("cxnr_trnst"),
        _overrun("operatorTATinHrs", OPERATOR_KM_PER_DAY).alias("fo_trnst"),
    ).distinct()
    return overruns.withColumn("sys_trnst_dly", transit_bucket(F.col("cxnr_trnst")))


def bucketed_trips(times: DataFrame) -> DataFrame:
    """Trips of ``trip_times`` with what is read from their document: both buckets and the partial-load flag."""
    return times.select(
        "code",
        "demand_id",
        "consigner_user_code",
        "trip_end_epoch",
        json_field(F.col("doc"), "ptl").alias("ptl"),
        loading_bucket(_loading_delay()).alias("gtl_delay"),
        # A trip without a bucket is kept as an empty name, so that it counts in its demand's set.
        F.coalesce(transit_bucket(_overrun("shipperTATinHrs", SHIPPER_KM_PER_DAY)), F.lit("")).alias("trnst_dly"),
    )


def _names_found(name: str, names: Iterable[str]) -> Column:
    """Aggregate: the different names of a column, all of them among ``names``, by one bit each."""
    bits = {n: 1 << k for k, n in enumerate(names)}
    found = F.bit_or(F.element_at(F.create_map(*[F.lit(x) for pair in bits.items() for x in pair]), F.col(name)))
    return F.array_compact(F.array(*[F.when(found.bitwiseAND(F.lit(b)) != 0, F.lit(n)) for n, b in bits.items()]))


def demand_buckets(bucketed: DataFrame) -> DataFrame:
    """Both bucket sets of each demand in one pass, combined by hash; the sets hold at most four and five names."""
    loading = [*[name for _, name in LOADING_BUCKETS], LOADING_LAST]
    transit = ["", *[name for _, name in TRANSIT_BUCKETS], TRANSIT_LAST]
    return bucketed.groupBy("demand_id").agg(
        _names_found("gtl_delay", loading).alias("gtl_delays"), _names_found("trnst_dly", transit).alias("trnst_dlys")
    )
