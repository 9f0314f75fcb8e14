"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

Targets: every source wants ``weight * level`` words, no more than ``max_epochs`` times what it has.
Raising one common level until the wanted words are shared out is the same as clamping sources and
resharing their excess by weight until none is above, and has a closed form once sources are sorted
by the level at which they fill up.

Documents: the whole part of ``target / source size`` is a number of passes over the source; the
fraction is one more pass over documents in a seeded order, as far as the words that are missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmetry.llm.common import WORD, staged, text_or_empty

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
#: Hexadecimal digits of a document's place that a level looks at, and levels: 16,777,216 buckets for a source.
DIGITS, LEVELS = 2, 3


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("bigint")


def place(doc_id: str, text: str, seed: str) -> Column:
    """A document's place in its source's seeded order: a digest of its id, or of its text if that is null."""
    own = F.coalesce(F.col(doc_id).cast("string"), F.md5(text_or_empty(text).cast("binary")))
    return F.md5(F.concat(F.lit(f"{seed}:"), own).cast("binary"))


def targets(
    totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """``totals`` (``source``, ``source_size``) with ``target``.

    Weights repeat over sources in code point order, null last. The windows see one row per source.
    A source without words has target 0.
    """
    order = F.col("source").asc_nulls_last()
    nth = (F.row_number().over(Window.orderBy(order)) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), nth.cast("int") + 1)
    cap = (max_epochs * F.col("source_size")).cast("bigint")
    rows = totals.withColumn("weight", weight).withColumn("cap", cap).withColumn("full_at", F.col("cap") / F.col("weight"))
    by_level = Window.orderBy("full_at", order)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rows = (
        rows.withColumn("wanted", share * F.sum("source_size").over(everything))
        .withColumn("level", (F.col("wanted") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward))
        # The first source that the level does not fill sets it for all from there on.
        .withColumn("final", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(everything)["level"])
    )
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("final") * F.col("weight"), F.col("cap").cast("double")))
    return rows.select("source", "source_size", F.when(F.col("source_size") > 0, target).otherwise(0.0).alias("target"))


def cuts(places: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source its target, its whole passes and the last place that the partial pass takes.

    Buckets of places are summed first, then the buckets within the one where the partial pass ends,
    and so on; so a source of any size is only ordered inside the last of them, and no window sees more
    than 256 rows of a source before. Documents of one place are taken or left together.
    """
    goals = goals.withColumn(
        "passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    ).withColumn("missing", F.col("target") - F.col("passes") * F.col("source_size"))
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    within = places.select("source", "place", "size").alias("a").join(
        goals.where("missing > 0").select("source", "missing", F.lit(0).cast("bigint").alias("before")).alias("b"), same
    ).select("a.source", "place", "size", "missing", "before")
    for level in range(1, LEVELS + 1):
        bucket = F.substring("place", 1, DIGITS * level)
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        ends = (
            within.groupBy("source", "missing", "before", bucket.alias("bucket"))
            .agg(F.sum("size").alias("size"))
            .withColumn("upto", F.col("before") + F.sum("size").over(upto))
            .withColumn("ahead", F.col("upto") - F.col("size"))
            .where("ahead < missing and missing <= upto")
        )
        within = (
            within.alias("a")
            .join(ends.alias("b"), same & (F.substring("a.place", 1, DIGITS * level) == F.col("b.bucket")))
            .select("a.source", "place", "a.size", "a.missing", F.col("ahead").alias("before"))
        )
    order = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        within.groupBy("source", "before", "missing", "place")
        .agg(F.sum("size").alias("size"))
        .withColumn("ahead", F.col("before") + F.sum("size").over(order) - F.col("size"))
        .groupBy("source", F.substring("place", 1, DIGITS * LEVELS).alias("bucket"))
        .agg(F.max(F.when(F.col("ahead") + F.col("size") / 2 <= F.col("missing"), F.col("place"))).alias("last"))
        .select("source", F.coalesce("last", "bucket").alias("last"))
    )
    return (
        goals.alias("a")
        .join(last.alias("b"), same, "left")
        .select("a.source", "source_size", "target", "passes", F.coalesce("last", F.lit("")).alias("last"))
    )


def mixed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` as one struct column ``row``, with ``source_size``, ``target``, ``size`` and ``copies``.

    A null text has size 0, null sources are one source, rows with one id and source share one place
    and so one decision. Reruns agree: places depend on the seed and the id alone.
    """
    made = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[source].alias("source"),
        word_count(text).alias("size"),
        place(doc_id, text, seed).alias("place"),
    )
    places = staged(made.select("source", "size", "place"), "places")
    totals = places.groupBy("source").agg(F.sum("size").alias("source_size"))
    limits = staged(cuts(places, targets(totals, weights, share, max_epochs)), "cuts")
    joined = made.alias("a").join(limits.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
    copies = F.col("passes") + (F.col("place") <= F.col("last")).cast("int")
    return joined.select("row", "size", "source_size", "target", F.least(copies, F.lit(max_epochs)).alias("copies"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its own columns."""
    taken = mixed(docs, **options).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
