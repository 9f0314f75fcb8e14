"""Merkle manifest of a table: nested-interval labels, containment joins, and a proof for every row.

Rows are leaves, ranked inside their group; every ``arity`` consecutive nodes become one node, the last
run as short as it falls. A node carries the interval ``[lo, hi)`` of leaf ranks that it covers. Nodes
are built and joined in strata of ``depth`` levels: inside a stratum the nodes fall into blocks of at
most ``arity ** depth`` units, so no task ever holds a tree, whatever a group's size.

Parents are found by a join on the level and the cell of the interval in it, ancestors by containment
in a block; what a parent's interval has beyond a node's own belongs to the node's siblings. The group
digests are the leaves of one more tree of the same kind.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmetry.llm.common import dropped, staged

ARITY = 2
#: Levels in a stratum: blocks of 64 units with an arity of 2.
DEPTH = 6
_STEPS = "array<struct<left: string, right: string>>"


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Digest of a row: of each value ``-`` if null, else its UTF-8 length, ``:`` and the value."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def folded(leaf: Column, steps: Column) -> Column:
    """Root that follows from a leaf and its siblings."""
    return F.aggregate(steps, leaf, lambda own, s: F.sha2(F.concat(s["left"], own, s["right"]), 256))


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings from the leaf's level upwards, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


class _Shape:
    """Powers of the arity as exact columns."""

    def __init__(self, arity: int, depth: int):
        if arity < 2 or depth < 1:
            raise ValueError("a tree needs an arity of 2 and strata of one level at least")
        self.arity, self.depth = arity, depth
        self.powers = [arity**k for k in range(64) if arity**k < 2**62]
        self._powers = F.expr(f"array({', '.join(f'{p}L' for p in self.powers)})")

    def power(self, level: Column | int) -> Column:
        """Leaves under a full node of that level; levels above any tree cover everything."""
        if isinstance(level, int):
            return F.lit(self.powers[level] if level < len(self.powers) else 2**62).cast("bigint")
        return F.coalesce(F.get(self._powers, level), F.lit(2**62))

    def height(self, n: Column) -> Column:
        return F.size(F.filter(self._powers, lambda p: p < n))

    def strata(self, n: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(self.height(n) / self.depth).cast("int"))


def _cell(lo: Column, width: Column) -> Column:
    return ((lo - lo % width) / width).cast("bigint")


def ranked(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``lo``, the rank from 0 in its group, and ``n``, the rows of the group.

    Rows are dealt by ranges of group and order, with their place as the last key, so that neither a
    group nor equal rows fill a task; ranks start at the rows of the ranges before. ``group`` is not null.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.withColumn("_row", F.monotonically_increasing_id())
    dealt = staged(placed.repartitionByRange(parts, *keys, "_row").withColumn("_part", F.spark_partition_id()), "dealt")
    every = Window.partitionBy("_g").orderBy("_p")
    counts = (
        dealt.groupBy(F.col(group).alias("_g"), F.col("_part").alias("_p"))
        .agg(F.count("*").alias("_c"))
        .withColumn("_ahead", F.coalesce(F.sum("_c").over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("n", F.sum("_c").over(Window.partitionBy("_g")))
    )
    inside = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*keys, "_row")) - 1
    found = dealt.withColumn("_in", inside).join(counts, (F.col(group) == F.col("_g")) & (F.col("_part") == F.col("_p")))
    kept = staged(found.select(*rows.columns, (F.col("_in") + F.col("_ahead")).alias("lo"), "n"), "ranked")
    dropped(dealt)
    return kept


def _grown(units: DataFrame, shape: _Shape, stratum: int) -> DataFrame:
    """All nodes of one stratum from its units: ``g``, ``n``, ``block``, ``level``, ``lo``, ``hi``, ``digest``."""
    base = stratum * shape.depth
    wide = shape.power(base + shape.depth)
    runs = units.groupBy("g", "n", _cell(F.col("lo"), wide).alias("block")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("lo", "digest"))), lambda u: u["digest"]).alias("own")
    )
    rise = F.least(F.lit(shape.depth), shape.height(F.col("n")) - base)

    def parents(nodes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(nodes), F.lit(shape.arity))
        return F.transform(starts, lambda at: F.sha2(F.array_join(F.slice(nodes, at, shape.arity), ""), 256))

    levels = F.aggregate(
        F.when(rise > 0, F.sequence(F.lit(1), rise)).otherwise(F.array().cast("array<int>")),
        F.array("own").cast("array<array<string>>"),
        lambda done, k: F.concat(done, F.array(parents(F.element_at(done, k)))),
    )
    rows = runs.select("g", "n", "block", F.posexplode(levels).alias("rise", "digests"))
    rows = rows.select("g", "n", "block", (F.col("rise") + base).alias("level"), F.posexplode("digests").alias("nth", "digest"))
    width = shape.power(F.col("level"))
    return rows.withColumn("lo", F.col("block") * wide + F.col("nth") * width).select(
        "g", "n", "block", "level", "lo", F.least(F.col("lo") + width, "n").alias("hi"), "digest"
    )


def grown(units: DataFrame, arity: int = ARITY, depth: int = DEPTH) -> list[DataFrame]:
    """Nodes of every stratum over leaves ``g``, ``lo``, ``n``, ``digest``; each is a written table."""
    shape, strata = _Shape(arity, depth), []
    most = units.agg(F.max(shape.strata(F.col("n")))).first()[0] or 0
    for s in range(most):
        strata.append(staged(_grown(units, shape, s), "nodes"))
        top = (s + 1) * depth
        units = strata[-1].where((F.col("level") == top) & (shape.height(F.col("n")) > top)).select("g", "n", "lo", "digest")
    return strata


def roots(strata: Sequence[DataFrame], arity: int = ARITY, depth: int = DEPTH) -> DataFrame:
    """``g``, ``n``, ``digest`` of the node that covers its whole group."""
    shape, found = _Shape(arity, depth), None
    for s, nodes in enumerate(strata):
        n = F.col("n")
        whole = (F.col("level") == shape.height(n)) & (shape.strata(n) == s + 1)
        part = nodes.where(whole).select("g", "n", "digest")
        found = part if found is None else found.union(part)
    return found


def _siblings(nodes: DataFrame, shape: _Shape) -> DataFrame:
    """Nodes below a parent of their stratum with the digests of their siblings on either side."""
    level = F.col("level")
    child = nodes.withColumn("up", level + 1).withColumn("cell", _cell(F.col("lo"), shape.power(level + 1)))
    parent = nodes.select(
        "g",
        "block",
        level.alias("up"),
        _cell(F.col("lo"), shape.power(level)).alias("cell"),
        F.col("lo").alias("p_lo"),
        F.col("hi").alias("p_hi"),
    )
    inside = child.join(parent, ["g", "block", "up", "cell"]).where("p_lo <= lo and hi <= p_hi")
    run = F.collect_list(F.struct("lo", "hi", "digest")).over(Window.partitionBy("g", "block", "up", "cell"))
    inside = inside.withColumn("run", F.array_sort(run))

    def joined(beside) -> Column:
        return F.array_join(F.transform(F.filter("run", beside), lambda s: s["digest"]), "")

    # The parent's interval without the node's own: [p_lo, lo) and [hi, p_hi).
    return inside.select(
        "g",
        "block",
        "level",
        F.col("lo").alias("s_lo"),
        F.col("hi").alias("s_hi"),
        joined(lambda s: (s["lo"] >= F.col("p_lo")) & (s["hi"] <= F.col("lo"))).alias("left"),
        joined(lambda s: (s["lo"] >= F.col("hi")) & (s["hi"] <= F.col("p_hi"))).alias("right"),
    )


def proofs(
    units: DataFrame,
    strata: Sequence[DataFrame],
    ends: DataFrame,
    payload: Sequence[str],
    arity: int = ARITY,
    depth: int = DEPTH,
) -> DataFrame:
    """``payload`` of every leaf with ``steps``, its siblings level by level, and what ``ends`` has.

    ``ends`` holds, per group, ``g``, ``n``, the ``steps`` that follow after the group's root and any
    other columns. Steps of a block are shared by all below it and joined downwards, so a level costs
    one row for each unit of its stratum.
    """
    shape = _Shape(arity, depth)
    extra = [c for c in ends.columns if c not in ("g", "n", "steps")]
    above = None
    for s in reversed(range(len(strata))):
        base = s * depth
        wide, width = shape.power(base + depth), shape.power(base)
        at_end = ends.where(shape.strata(F.col("n")) == s + 1).select("g", F.lit(0).cast("bigint").alias("block"), F.col("steps").alias("after"), *extra)
        higher = at_end if above is None else above.union(at_end)
        shown = list(payload) if s == 0 else []
        source = units if s == 0 else strata[s].where(F.col("level") == base)
        low = source.select("g", _cell(F.col("lo"), wide).alias("block"), "lo", F.least(F.col("lo") + width, "n").alias("hi"), *shown)
        step = F.when(F.col("level").isNotNull(), F.struct("level", "left", "right"))
        own = (
            low.join(_siblings(strata[s], shape).withColumnsRenamed({"g": "_g", "block": "_b"}), F.expr("g = _g and block = _b and s_lo <= lo and hi <= s_hi"), "left")
            .groupBy("g", "block", "lo", *shown)
            .agg(F.array_sort(F.collect_list(step)).alias("own"))
        )
        steps = F.concat(F.transform("own", lambda x: F.struct(x["left"].alias("left"), x["right"].alias("right"))).cast(_STEPS), "after")
        whole = own.join(higher, ["g", "block"])
        if s == 0:
            return whole.select(*payload, steps.alias("steps"), *extra)
        above = staged(whole.select("g", _cell(F.col("lo"), shape.power(base)).alias("block"), steps.alias("after"), *extra), "above")
    return None


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    group: str = "lang",
    more: Mapping[str, Column] | None = None,
    arity: int = ARITY,
    depth: int = DEPTH,
) -> DataFrame:
    """One row per row: ``key``, ``leaf``, ``steps``, ``subroot`` (of its group), ``root`` and ``more``.

    Leaves of a group stand in ascending order of ``key``, a null key first, rows of one key by their
    digest; equal rows have equal leaves and each its own proof. Groups stand in the order of their
    UTF-8 bytes, null first. Null and empty values differ. An empty table has no root and no rows.
    ``more`` are columns computed from ``docs`` that go through unchanged; other columns play no part.
    """
    more = dict(more or {})
    made = docs.select(
        F.coalesce(F.concat(F.lit("="), docs[group].cast("string")), F.lit("")).alias("g"),
        docs[key].alias("_key"),
        leaf_digest([docs[c] for c in columns]).alias("digest"),
        *[c.alias(f"_more_{name}") for name, c in more.items()],
    )
    leaves = staged(made, "leaves")
    units = ranked(leaves, "g", ("_key", "digest"))
    dropped(leaves)
    strata = grown(units, arity, depth)
    if not strata:
        return units.select(F.col("_key").alias(key), F.col("digest").alias("leaf"), F.lit(None).cast(_STEPS).alias("steps"), *[F.lit(None).cast("string").alias(c) for c in ("subroot", "root")], *[F.col(f"_more_{m}").alias(m) for m in more])

    tops = roots(strata, arity, depth).select(F.col("g").alias("_group"), F.col("n").alias("_leaves"), "digest")
    subs = ranked(tops.withColumn("g", F.lit("")), "g", ("_group",))
    trunk = grown(subs, arity, depth)
    end = roots(trunk, arity, depth).select("g", "n", F.array().cast(_STEPS).alias("steps"), F.col("digest").alias("root"))
    ends = proofs(subs, trunk, end, ("_group", "_leaves", "digest"), arity, depth)
    ends = staged(ends.select(F.col("_group").alias("g"), F.col("_leaves").alias("n"), "steps", F.col("digest").alias("subroot"), "root"), "subroots")

    found = proofs(units, strata, ends, ("_key", "digest", *[f"_more_{m}" for m in more]), arity, depth)
    shown = [F.col("_key").alias(key), F.col("digest").alias("leaf"), "steps", "subroot", "root"]
    return found.select(*shown, *[F.col(f"_more_{m}").alias(m) for m in more])


def verified(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, and the check of every row after some were tampered with.

    A row whose id's crc32 is divisible by 7 has 1 added to ``n_chars`` (a null stays null, and a row
    without id is left alone); its leaf is computed anew and folded with the siblings of the original.
    """
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    altered = [docs[c] if c != "n_chars" else (docs[c].cast("decimal(20,0)") + 1) for c in columns]
    hit = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0
    rows = manifest(docs, columns, more={"altered": F.when(hit, leaf_digest(altered))})
    again = rows.withColumn("folded_root", folded(F.coalesce("altered", "leaf"), F.col("steps")))
    return again.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("steps")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
