"""Row-level building blocks that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, TimestampNTZType


def pick_last(order: Column, *payload: str, when: Column | None = None) -> Column:
    """Aggregate: struct of the payload of the row with the greatest ``order``.

    A NULL order counts as the greatest, as in the warehouse's descending order. Ties go to
    the greatest payload, so the result does not depend on input order.
    """
    packed = F.struct(order.isNull().alias("_unset"), order.alias("_order"), *payload)
    return F.max(packed if when is None else F.when(when, packed))


def pick_first(order: Column, *payload: str, when: Column | None = None) -> Column:
    """Aggregate: payload of the row with the smallest ``order``; a NULL order counts last."""
    packed = F.struct(order.isNull().alias("_unset"), order.alias("_order"), *payload)
    return F.min(packed if when is None else F.when(when, packed))


#: A time in microseconds and a whole number side by side in a 38-digit decimal: 61 bits and 65 bits.
_TIME_EDGE, _UNSET, _NUMBER_EDGE, _PLACE = 2**59, 2**60, 2**63, Decimal(2**65)


def _exact(col: Column) -> Column:
    return col.cast("decimal(20,0)")


def latest_number(order: Column, value: Column, when: Column | None = None) -> Column:
    """Aggregate: the whole number of the row with the greatest ``order`` (a local time).

    What ``pick_last`` finds, but of fixed width, so that it is combined in a hash table and not by
    sorting all rows first. Order and value are packed into one decimal whose order is theirs: a NULL
    order is the greatest, a NULL value the smallest of its order. Times outside the years -16000 to
    20000 count as equal to that edge.
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), order)
    edge = F.lit(_TIME_EDGE)
    placed = F.coalesce(F.greatest(-edge, F.least(edge, micros)) + edge, F.lit(2 * _TIME_EDGE + _UNSET))
    number = F.coalesce(_exact(value) + F.lit(Decimal(_NUMBER_EDGE + 1)), F.lit(Decimal(0)))
    packed = _exact(placed) * F.lit(_PLACE) + number
    found = F.max(packed if when is None else F.when(when, packed)) % F.lit(_PLACE)
    return F.when(found > 0, found - F.lit(Decimal(_NUMBER_EDGE + 1))).cast("bigint")


def latest_time(order: Column) -> Column:
    """Aggregate: the greatest time, NULL where any is NULL, as a NULL counts as the latest."""
    return F.when(F.count_if(order.isNull()) == 0, F.max(order))


def _one_row(df: DataFrame, keys: Sequence[str], picked: Column, payload: Sequence[str]) -> DataFrame:
    chosen = df.groupBy(*keys).agg(picked.alias("_row"))
    return chosen.select(*keys, *[F.col(f"_row.{name}").alias(name) for name in payload])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str, payload: Sequence[str]) -> DataFrame:
    """One row per key, the latest by ``order``. An aggregate, so maps combine before the shuffle.

    A single whole number as payload is combined by hash; anything wider or text is sorted by key first.
    """
    if isinstance(df.schema[order].dataType, TimestampNTZType) and len(payload) == 1:
        kind = df.schema[payload[0]].dataType
        if isinstance(kind, (IntegerType, LongType)):
            picked = latest_number(F.col(order), F.col(payload[0])).cast(kind).alias(payload[0])
            return df.groupBy(*keys).agg(picked)
    return _one_row(df, keys, pick_last(F.col(order), *payload), payload)


def earliest_per_key(df: DataFrame, keys: Sequence[str], order: str, payload: Sequence[str]) -> DataFrame:
    """One row per key, the earliest by ``order``."""
    return _one_row(df, keys, pick_first(F.col(order), *payload), payload)


def dealt_in_order(
    df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str], parts: int | None = None
) -> DataFrame:
    """Rows dealt over partitions by key, ``order`` descending (NULL first) and ``ties``, with their partition.

    The whole sort key is dealt by ranges, so no key, time or missing time fills a partition; rows
    equal in all of it are told apart by their place. Write the result before it is numbered: the
    columns ``_row`` and ``_part`` must not be computed twice.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        df.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys, F.col(order).desc_nulls_first(), *[F.col(t).asc_nulls_last() for t in ties], "_row")
        .withColumn("_part", F.spark_partition_id())
    )


def ordinal_within(dealt: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str], name: str) -> DataFrame:
    """Row number inside each key by ``order`` descending (NULL first), then ``ties`` ascending.

    Takes what ``dealt_in_order`` made. Rows are numbered inside (key, partition) and lifted by the
    key's rows in earlier partitions, of which there is one count each.
    """
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(*keys, "_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            *[F.col(k).alias(f"_key_{k}") for k in keys],
            F.col("_part").alias("_key_part"),
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
        )
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(
        F.col(order).desc_nulls_first(), *[F.col(t).asc_nulls_last() for t in ties], "_row"
    )
    numbered = dealt.withColumn("_local", F.row_number().over(inside))
    same = F.col("_part") == F.col("_key_part")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    shown = [c for c in dealt.columns if c not in ("_row", "_part")]
    lifted = numbered.join(offsets, same, "inner")
    return lifted.withColumn(name, (F.col("_local") + F.col("_offset")).cast("bigint")).select(*shown, name)


#: Identical rows are unfolded in two steps, so that no array grows with their number.
_UNFOLD = 10_000


#: Writes a frame and goes on from what is written, as ``Stage.keep`` does.
Keep = Callable[[DataFrame], DataFrame]


def as_is(df: DataFrame) -> DataFrame:
    """Keeps nothing: the frame is computed wherever it is read."""
    return df


def fanout_left_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    identical_rows: bool = False,
    hot_rows: int = 100_000,
    keep: Keep = as_is,
) -> DataFrame:
    """Left join whose right side may repeat a key very often.

    Spark splits a hot left-hand key of a left outer join by itself, but never a hot
    right-hand key. So a key with more than ``hot_rows`` right rows is salted, with one salt for
    every ``hot_rows`` of them: its right rows are dealt over the salts and its left rows repeated
    per salt. There are at most ``rows / hot_rows`` such keys, and as many salts in all, but for
    one a key. ``right`` is read twice; stage it when it is costly.

    With ``keep`` the right side is written and its keys are counted at once. Where none is that
    frequent, the join is a plain one on ``on``, so that what is dealt by these keys is not dealt again.

    Rows are dealt by their content. Set ``identical_rows`` where many rows may be equal in
    every column; they are then folded to one row with a count before the shuffle.
    """
    on = list(on)
    # A NULL key never matches, so those rows need not travel.
    sided = right.dropna(subset=on)
    if keep is not as_is:
        sided = keep(sided)
        if sided.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).isEmpty():
            return left.join(sided, on, "left")
    if identical_rows:
        sided = sided.groupBy(*right.columns).agg(F.count(F.lit(1)).alias("_copies"))
    else:
        sided = sided.withColumn("_copies", F.lit(1).cast("bigint"))
    hot = sided.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    hot = hot.select(*on, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    dealt = F.pmod(F.xxhash64(*right.columns), F.col("_salts")).cast("int")
    salted = (
        sided.join(hot, on, "left").withColumn("_salt", F.coalesce(dealt, F.lit(0))).drop("_salts")
    )
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = left.join(hot, on, "left").withColumn("_salt", F.explode(every))
    joined = repeated.join(salted, [*on, "_salt"], "left")
    # A hot key has right rows, so its salts without a match are not unmatched left rows.
    kept = joined.where(F.col("_salts").isNull() | F.col("_copies").isNotNull())
    if identical_rows:
        copies = F.coalesce("_copies", F.lit(1))
        kept = kept.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((copies - 1) / _UNFOLD))))
        rest = F.least(F.lit(_UNFOLD), copies - F.col("_chunk") * _UNFOLD)
        kept = kept.withColumn("_copies", F.explode(F.sequence(F.lit(1), rest)))
    return kept.drop("_salt", "_salts", "_copies", "_chunk")


def without_matches(df: DataFrame, others: DataFrame, on: Sequence[str]) -> DataFrame:
    """Anti join; the other side is reduced to its distinct keys first."""
    return df.join(others.select(*on).distinct(), list(on), "left_anti")


def rows_of_listed(df: DataFrame, column: str, values: DataFrame, most: int = 1_000) -> DataFrame:
    """Rows whose ``column`` is among those of ``values``, by a list that reaches the scan.

    A list of at most ``most`` different values becomes part of the query, so Parquet skips row groups
    and a database sends only these rows; ``values`` is read for it at once. A longer one is joined.
    """
    different = values.select(column).where(F.col(column).isNotNull()).distinct()
    found = different.limit(most + 1).agg(F.sort_array(F.collect_set(column))).first()[0]
    if len(found) > most:
        return df.join(different, column, "left_semi")
    return df.where(F.col(column).isin(*found) if found else F.lit(False))
