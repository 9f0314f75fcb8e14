"""Time expressions.

Sources keep UTC instants, either as epoch seconds or as ``timestamp_ntz``. Reports use a
naive local clock at a fixed offset. Nothing here depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the local clock is UTC + 5:30.
LOCAL_SHIFT_SECONDS = 19_800

UNIT_SECONDS = {"minute": 60, "hour": 3_600, "day": 86_400}
GRAINS = {"day": "DAY", "week": "WEEK", "month": "MM"}


def _epoch() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds to a UTC ``timestamp_ntz``."""
    zero = F.lit(0)
    return _epoch() + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def local_from_epoch(seconds: Column) -> Column:
    """Epoch seconds to the local clock."""
    return from_epoch(seconds + F.lit(LOCAL_SHIFT_SECONDS))


def to_local(ts: Column) -> Column:
    """UTC ``timestamp_ntz`` to the local clock."""
    return ts + F.expr("INTERVAL '05:30' HOUR TO MINUTE")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a ``timestamp_ntz``."""
    seconds = (ts - _epoch()).cast("interval second").cast("decimal(18,6)")
    return (seconds * 1_000_000).cast("bigint")


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """Unit boundaries crossed between two timestamps (10:59 to 11:01 is one hour)."""
    size = UNIT_SECONDS[unit] * 1_000_000

    def index(ts: Column) -> Column:
        micros = epoch_micros(ts)
        return (micros - F.pmod(micros, F.lit(size))) / F.lit(size)

    return (index(end) - index(start)).cast("bigint")


def epoch_boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """``boundary_diff`` on the local clock for epoch-second columns (integers stay integers)."""
    size = UNIT_SECONDS[unit]

    def index(seconds: Column) -> Column:
        shifted = seconds + F.lit(LOCAL_SHIFT_SECONDS)
        return (shifted - F.pmod(shifted, F.lit(size))) / F.lit(size)

    return (index(end) - index(start)).cast("bigint")


def period(ts: Column, grain: str) -> Column:
    """First date of the day, Monday week or month."""
    day = F.to_date(ts)
    return day if grain == "day" else F.trunc(day, GRAINS[grain])


def week_range_label(ts: Column) -> Column:
    """Monday-to-Sunday range such as ``29-Jan-24 - 04-Feb-24``."""
    monday = period(ts, "week")
    sunday = F.date_add(monday, 6)
    return F.concat(F.date_format(monday, "dd-MMM-yy"), F.lit(" - "), F.date_format(sunday, "dd-MMM-yy"))


def month_label(ts: Column) -> Column:
    """Month such as ``Jan'24``."""
    return F.date_format(F.to_date(ts), "MMM''yy")


def calendar_labels(df, ts: str, with_date: bool = False):
    """Add ``week_date`` and ``month_year`` (and ``date``) for a timestamp or date column."""
    labelled = df.withColumns({"week_date": week_range_label(F.col(ts)), "month_year": month_label(F.col(ts))})
    return labelled.withColumn("date", F.to_date(F.col(ts))) if with_date else labelled
