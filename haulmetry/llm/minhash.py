"""Near-duplicate classes: ProbMinHash signatures, banding, exact verification, connected classes.

A document is the weighted set of its five-word shingles, the weight being ``1 + ln(count)``. The
similarity is the probability Jaccard index, which for equal weights is the plain Jaccard index:
``sum over common i of 1 / sum over j of max(x_j / x_i, y_j / y_i)``.

Texts that are equal in their words are one node from the start, whatever their number. Nodes that
share a band of their signatures are candidates. A band's members are compared with one member, and
then those that are still of different classes with each other; so a band of copies costs one
comparison a member, classes miss no link, and no band is gathered in one task. Only candidates whose
signatures' sketches are near are verified, and only their texts are read again.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetry.llm.common import (
    _GOLDEN,
    SHINGLE_WORD,
    SIMILAR,
    WordHashes,
    dropped,
    mix,
    settings,
    shingle_batch,
    shingle_hashes,
    slices,
    staged,
)

#: 42 bands of 6 values: two documents of similarity 0.8 share no band with probability 3e-6.
BANDS, BAND_ROWS = 42, 6
#: Rounds of comparing bands with single members before all that is left is compared.
ROUNDS = 3
#: Four bits of each value make a sketch, a plane of bits in four numbers each. Two texts of similarity
#: 0.8 differ in 50 values with a deviation of 6, and in no more places of their sketches; candidates that
#: differ in more than five deviations above that are not read again. That loses 1e-6 of such pairs,
#: less than banding does.
PLANES, PLANE = 4, -(-BANDS * BAND_ROWS // 64)
FARTHEST = int(BANDS * BAND_ROWS * 0.2 + 5 * (BANDS * BAND_ROWS * 0.2 * 0.8) ** 0.5)
#: Members of one band, still in different classes, that meet in one task; more are dealt in such groups.
TOGETHER = 1000
#: Bits of the filter that finds rows to be left out, at most: 8 MB.
FILTER = 1 << 26
#: A Bloom filter of the paired rows goes to the scan of the texts, whatever the sizes of both.
PREFILTER = {
    "spark__sql__optimizer__runtime__bloomFilter__enabled": "true",
    "spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold": "0",
    "spark__sql__optimizer__runtime__bloomFilter__creationSideThreshold": "1t",
}


def weighted_shingles(text: str | None, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in ascending order, and their weights."""
    if not text:
        return np.zeros(0, np.uint64), np.zeros(0, np.float64)
    found, counts = np.unique(shingle_hashes(hashes.of(SHINGLE_WORD.findall(text.lower()))), return_counts=True)
    return found, 1.0 + np.log(counts)


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(elements: list[np.ndarray], weights: list[np.ndarray], size: int = BANDS * BAND_ROWS) -> np.ndarray:
    """ProbMinHash of several non-empty sets: which element arrives first at each of ``size`` places.

    Each element arrives as a Poisson process of its weight's rate, each arrival at a random place.
    A round takes the next arrivals of all elements still in play: at first together as many as fill
    all places of their set, then one each. An element is done as soon as it arrives later than the
    latest first arrival of its set, since times only grow.
    """
    sets = len(elements)
    best, owner = np.full(sets * size, np.inf), np.zeros(sets * size, np.uint64)
    of = np.repeat(np.arange(sets), [len(e) for e in elements])
    at, rate = np.concatenate(elements), np.concatenate(weights)
    state, when = at, np.zeros(len(at))
    wanted = np.full(sets, int(size * (np.log(size) + 1)))
    while len(at):
        alive = np.maximum(np.bincount(of, minlength=sets), 1)
        each = np.maximum(-(-wanted // alive), 1)[of]
        upto = np.cumsum(each)
        row = np.repeat(np.arange(len(at)), each)
        nth = np.arange(1, len(row) + 1) - (upto - each)[row]
        with np.errstate(over="ignore"):
            states = state[row] + _GOLDEN * nth.astype(np.uint64)
        draws = mix(states)
        gaps = -np.log(_uniform(draws)) / rate[row]
        total = np.cumsum(gaps)
        times = when[row] + total - (total - gaps)[upto - each][row]
        place = of[row] * size + (((mix(draws) >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(best, place, times)
        first = np.flatnonzero(times == best[place])
        owner[place[first]] = at[row[first]]
        latest = best.reshape(sets, size).max(axis=1)
        play = times[upto - 1] < latest[of]
        when, state = times[upto - 1][play], states[upto - 1][play]
        at, rate, of = at[play], rate[play], of[play]
        wanted = np.where(np.isfinite(latest), 0, size)
    return owner.reshape(sets, size)


def band_keys(owners: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """For each signature one 64-bit key a band, the band's number included."""
    rows = owners.reshape(len(owners), bands, -1)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN, rows.shape[:2])
        for r in range(rows.shape[2]):
            key = mix(key + rows[:, :, r])
    return key.view(np.int64)


def sketches(owners: np.ndarray) -> np.ndarray:
    """Bits of each value of a signature, plane by plane, as 64-bit numbers."""
    drawn = mix(owners + _GOLDEN)
    bits = np.zeros((len(owners), PLANES, 64 * PLANE), np.uint8)
    for k in range(PLANES):
        bits[:, k, : owners.shape[1]] = (drawn >> np.uint64(k)) & np.uint64(1)
    return np.packbits(bits, axis=2, bitorder="little").view("<i8").reshape(len(owners), -1)


def _near(x: str, y: str) -> Column:
    """Whether two texts may be similar, by their sketches in columns of these names."""
    apart = []
    for k in range(PLANE):
        planes = [F.get(x, p * PLANE + k).bitwiseXOR(F.get(y, p * PLANE + k)) for p in range(PLANES)]
        apart.append(F.bit_count(reduce(Column.bitwiseOR, planes)))
    return reduce(operator.add, apart) <= FARTHEST


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Similarity of two weighted sets given as ascending distinct hashes and weights, exact but for rounding."""
    if not len(a) or not len(b):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    ia = np.flatnonzero(b[at] == a)
    if not len(ia):
        return 0.0
    x, y = wa[ia], wb[at[ia]]
    if (wa == 1.0).all() and (wb == 1.0).all():
        return len(ia) / (len(a) + len(b) - len(ia))
    only = (wa.sum() - x.sum()), (wb.sum() - y.sum())
    # With r = x_i / y_i, element j adds max(x_j / x_i, y_j / y_i) = max(x_j, r y_j) / x_i: sort the
    # common elements by x_j / y_j, and each i splits them into those that add x_j and those that add r y_j.
    r = x / y
    order = np.argsort(r, kind="stable")
    below = np.searchsorted(r[order], r, side="right")
    cx, cy = (np.concatenate(([0.0], np.cumsum(v[order]))) for v in (x, y))
    common = (cx[-1] - cx[below]) + r * cy[below]
    return float(np.sum(x / (common + only[0] + r * only[1])))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    hashes = WordHashes()
    for batch in slices(batches, 64):
        words = [SHINGLE_WORD.findall(text.lower()) if text else [] for text in batch.column(1).to_pylist()]
        keys = [hashlib.md5(" ".join(w).encode("utf-8", "surrogatepass")).digest() if w else None for w in words]
        bands: list = [None] * len(words)
        sketch: list = [None] * len(words)
        some = [k for k, w in enumerate(words) if w]
        if some:
            sets = [np.unique(s, return_counts=True) for s in shingle_batch([words[k] for k in some], hashes)]
            owners = signatures([s for s, _ in sets], [1.0 + np.log(n) for _, n in sets])
            for k, mine, short in zip(some, band_keys(owners), sketches(owners), strict=True):
                bands[k], sketch[k] = mine, short
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(keys, pa.binary()), *(pa.array(x, pa.list_(pa.int64())) for x in (bands, sketch))],
            ["id", "row", "key", "bands", "sketch"],
        )


def _with_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in slices(batches, 64):
        made = [weighted_shingles(text, hashes) for text in batch.column("text").to_pylist()]
        sets = [found.tobytes() for found, _ in made]
        weights = [b"" if (w == 1.0).all() else w.tobytes() for _, w in made]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(sets, pa.binary()), pa.array(weights, pa.binary())], ["id", "set", "weights"]
        )


def _verified(least: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def read(found: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
        a = np.frombuffer(found, np.uint64)
        return a, np.frombuffer(weights, np.float64) if weights else np.ones(len(a))

    for batch in slices(batches, 64):
        sides = (c.to_pylist() for c in batch.columns[2:])
        s = np.array([probability_jaccard(*read(p, q), *read(r, t)) for p, q, r, t in zip(*sides, strict=True)])
        found = pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(s, pa.float64())], ["a", "b", "similarity"])
        yield found.filter(pa.array(s >= least - 1e-12, pa.bool_()))


def verified_pairs(pairs: DataFrame, rows: DataFrame, texts: DataFrame, least: float = SIMILAR) -> DataFrame:
    """``pairs`` (``a``, ``b``) of at least that similarity.

    ``rows`` (``node``, ``row``) names a row of ``texts`` (``row``, ``text``) for each node. Only texts
    that occur in a pair are read into shingles. A node with a great many pairs is on the side of a
    join that Spark can split.
    """
    paired = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    ids = staged(rows.join(paired, "node").select(F.col("node").alias("id"), "row"), "paired")
    # Spark drops most texts that are in no pair by a Bloom filter of at most 8 MB, before they are
    # shuffled. It makes one only from rows that a condition chose; this one holds for all.
    with settings(ids.sparkSession, **PREFILTER):
        sets = staged(
            texts.join(ids.where("id >= 0"), "row")
            .select("id", "text")
            .dropDuplicates(["id"])
            .mapInArrow(_with_shingles, "id bigint, set binary, weights binary"),
            "shingles",
        )
    left, right = (sets.select(F.col("id").alias(n), F.col("set").alias(f"{n}_set"), F.col("weights").alias(f"{n}_weights")) for n in "ab")
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "a_set", "a_weights", "b_set", "b_weights")
    links = staged(both.mapInArrow(partial(_verified, least), "a bigint, b bigint, similarity double"), "links")
    dropped(sets)
    dropped(ids)
    return links


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node that has a link: the root is the smallest node it is connected to.

    Alternates two steps: join larger neighbours to the smallest one around, then smaller ones. Each
    round halves the distance to the root at least, and each is written to the shared folder.
    """
    def starred(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.union(edges.select("b", "a")) if large else edges
        # a is the larger end of an edge; in the small step its neighbours are smaller ones only.
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        near = both.join(least, "a")
        if large:
            new = near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            new = near.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                least.select("a", F.col("m").alias("b"))
            )
        return new.where("a != b").distinct()

    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    size, moved = edges.count(), True
    while size and moved:
        new = staged(starred(starred(edges, True), False), "edges")
        last, size = size, new.count()
        # The edges are distinct: as many as before, all known, are the same ones.
        moved = size != last or not new.join(edges, ["a", "b"], "left_anti").isEmpty()
        dropped(edges)
        edges = new
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _row(doc_id: Column, text: Column) -> Column:
    """Names a row by its id and text, so that rows of one id, or of none, are told apart by their texts."""
    named = F.concat(F.coalesce(doc_id.cast("bigint").cast("string"), F.lit("")), F.lit(":"), F.coalesce(text.cast("string"), F.lit("")))
    return F.unhex(F.md5(named.cast("binary")))


def _classed(docs: DataFrame, doc_id: str, text: str, least: float) -> DataFrame:
    """``id``, ``row``, ``root``, ``class_id``, ``copies`` per row of ``docs``; ``root`` is null for a text without words."""
    source = docs.select(
        docs[doc_id].cast("bigint").alias("id"), docs[text].cast("string").alias("text"), _row(docs[doc_id], docs[text]).alias("row")
    )
    signed = staged(source.mapInArrow(_signed, "id bigint, row binary, key binary, bands array<bigint>, sketch array<bigint>"), "signed")
    keyed = signed.where("key is not null")
    alike = [F.first(c).alias(c) for c in ("bands", "sketch")]  # equal words have equal signatures
    grouped = keyed.groupBy("key").agg(F.min("row").alias("row"), F.min("id").alias("least_id"), F.count("*").alias("copies"), *alike)
    known = staged(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")  # numbers stay, once written
    rows, texts = known.select("node", "row"), source.select("row", "text")

    band = known.select("node", F.posexplode("bands").alias("nth", "band"))
    shared = band.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("first")).where("n > 1")
    members = staged(band.join(shared, "band").select("nth", "band", "node", "first"), "members")
    # Most texts share no band; only the sketches of the others are shuffled again.
    held = staged(known.select("node", "sketch").join(members.select("node").distinct(), "node"), "held")

    def sketched(df: DataFrame, node: str, name: str) -> DataFrame:
        return df.join(held.select(F.col("node").alias(node), F.col("sketch").alias(name)), node)

    stars = members.where("node != first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    pairs = staged(sketched(sketched(stars, "b", "y"), "a", "x").where(_near("x", "y")).select("a", "b"), "pairs")
    links = verified_pairs(pairs, rows, texts, least)
    roots = components(links)

    def unsettled() -> DataFrame:
        """Members of bands that hold several classes; the links of the other bands can't change a class."""
        placed = members.join(roots, "node", "left").select("nth", "band", "node", F.coalesce("root", "node").alias("root"))
        several = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).where("low != high")
        return staged(sketched(placed.join(several.select("band", "n"), "band"), "node", "sketch"), "open")

    def joined(x: DataFrame, y: DataFrame, on: list[str], every: bool) -> bool:
        """Compare members of different classes that were not compared yet; whether classes changed."""
        nonlocal pairs, links, roots
        # Where all members meet all, a pair that shares several bands counts in the first of them.
        once = F.expr("x.root != y.root and x.node < y.node and not arrays_overlap(x.before, y.before)")
        new = (
            x.alias("x")
            .join(y.alias("y"), on)
            .where((once if every else F.expr("x.root != y.root")) & _near("x.sketch", "y.sketch"))
            .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
            .distinct()
            .join(pairs, ["a", "b"], "left_anti")
        )
        new = staged(new, "pairs")
        found = verified_pairs(new, rows, texts, least)
        pairs = pairs.union(new)
        if found.isEmpty():
            return False
        links = links.union(found)
        roots = components(links)
        return True

    # A few rounds against another member of each band join what can be joined at one row a member;
    # few classes are left for the last round, in which all that are still apart meet.
    for k in range(ROUNDS):
        rest = unsettled()
        turn = F.xxhash64("node", "band", F.lit(k))
        centre = rest.groupBy("band").agg(F.min_by(F.struct("node", "root", "sketch"), turn).alias("c")).select("band", "c.*")
        changed = joined(centre, rest, ["band"], False)
        dropped(rest)
        if not changed:
            break
    rest = unsettled()
    # A member's shared bands that come before this one; a pair's shared bands are among them.
    own = members.groupBy("node").agg(F.collect_list(F.struct("nth", "band")).alias("own"))
    before = F.transform(F.filter("own", lambda s: s["nth"] < F.col("nth")), lambda s: s["band"])
    rest = staged(rest.join(own, "node").select(*rest.columns, before.alias("before")), "rest")
    # One side of a large band is dealt to groups, the other goes to each, so no task sees a whole band's pairs.
    groups = F.ceil(F.col("n") / TOGETHER)
    dealt = rest.withColumn("group", F.pmod(F.xxhash64("node"), groups))
    spread = rest.withColumn("group", F.explode(F.sequence(F.lit(0).cast("bigint"), groups - 1)))
    joined(dealt, spread, ["band", "group"], True)
    dropped(rest)
    dropped(members)
    dropped(held)
    lowest = roots.join(known.select("node", "least_id"), "node").groupBy("root").agg(F.min("least_id").alias("class_id"))
    classes = (
        known.join(roots, "node", "left")
        .join(lowest, "root", "left")
        .select("key", F.coalesce("root", "node").alias("root"), F.when(F.col("root").isNull(), F.col("least_id")).otherwise(F.col("class_id")).alias("class_id"), "copies")
    )
    found = keyed.select("id", "row", "key").join(classes, "key").select("id", "row", "root", "class_id", "copies")
    alone = signed.where("key is null").select(
        "id", "row", F.lit(None).cast("bigint").alias("root"), F.col("id").alias("class_id"), F.lit(1).cast("bigint").alias("copies")
    )
    return found.union(alone)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILAR) -> DataFrame:
    """``doc_id``, ``class_id`` (the smallest id of its class) and ``copies`` (rows of equal words), one row per input row.

    Rows of one id with different texts are documents of their own. A text without words, null or
    empty, is like no other: its class is its own id. A row without id is compared as all others; a
    class without any id has a null class. A text of fewer than five words is one shingle. An empty
    table gives no rows.
    """
    return _classed(docs, doc_id, text, least).select(F.col("id").alias("doc_id"), "class_id", "copies")


def _places(bits: int) -> tuple[Column, Column]:
    """Two places of a row among so many bits."""
    return tuple(F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(bits)) for seed in (1, 2))


def _may_hold(rows: DataFrame) -> Column:
    """Whether a ``row`` may be among ``rows``: true for each of them and, up to 4 million, for 2 % of others.

    A Bloom filter of at most ``FILTER`` bits, made on the cluster and sent to the tasks.
    """
    spark = rows.sparkSession
    bits = min(FILTER, 1 << max(16, (16 * rows.count()).bit_length()))
    place = rows.select(F.explode(F.array(*_places(bits))).alias("place"))
    word = F.shiftrightunsigned("place", 6).cast("int").alias("word")
    one = F.expr("shiftleft(1L, cast(place & 63 as int))")
    found = place.groupBy(word).agg(F.bit_or(one).alias("set")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[found.column("word").to_numpy()] = found.column("set").to_numpy().view(np.uint64)
    sent = spark.sparkContext.broadcast(words)

    def holds(first: pa.Array, second: pa.Array) -> pa.Array:
        both = [x.to_numpy(zero_copy_only=False) for x in (first, second)]
        seen = [(sent.value[x >> 6] >> (x & 63).astype(np.uint64)) & np.uint64(1) for x in both]
        return pa.array((seen[0] & seen[1]).astype(bool))

    return F.arrow_udf(holds, "boolean")(*_places(bits))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILAR) -> DataFrame:
    """``docs`` without near-duplicates: of each class the document of the smallest id, in one row.

    Rows are told apart by id and text. A class that has no id keeps one of its texts. Of rows equal
    in id and text one stays, also where the text has no words; a text without words and id stays.
    """
    classes = staged(_classed(docs, doc_id, text, least), "classes")
    best = F.min(F.struct(F.col("id").isNull(), "id", "row"))["row"].alias("best")
    chosen = classes.where("root is not null").groupBy("root").agg(best, F.count("*").alias("n")).where("n > 1")
    gone = classes.join(chosen, "root").where("row != best").select("row").distinct()
    twice = classes.where("root is not null or id is not null").groupBy("row").count().where("count > 1").select("row")
    gone, twice = staged(gone, "gone"), staged(twice, "twice")
    named = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), _row(docs[doc_id], docs[text]).alias("row"))
    # Most rows are neither gone nor there twice: they stay where they are, and only the others are shuffled.
    listed = _may_hold(gone.union(twice))
    kept = named.where(listed).join(gone, "row", "left_anti")
    return (
        named.where(~listed)
        .unionByName(kept.join(twice, "row", "left_anti"))
        .unionByName(kept.join(twice, "row", "left_semi").dropDuplicates(["row"]))
        .select("_doc.*")
    )
