"""Benchmark decontamination with SimHash windows and a multi-index.

A benchmark item of n words is compared with every window of n words of every document. Window and
item are weighted sets of five-word shingles, the weight being the count; a match is a weighted
Jaccard index of at least 0.8.

Candidates come from 64-bit SimHash fingerprints: windows within ``RADIUS`` bits of an item. The
fingerprint is cut into ``BLOCKS`` blocks; of two fingerprints that differ in at most ``RADIUS`` bits,
some block differs in at most ``RADIUS // BLOCKS`` bits. A table per block lists the items for every
value within that distance, so looking up a window's blocks finds all items within the radius, and
nothing has to be compared with all. Every candidate is then verified exactly.

A window without a shingle of an item has similarity 0 with it. So posting lists lead from the shingles
that a text shares with items to the pairs of window and item that can match at all; these are looked
up in the index, and only such windows are fingerprinted. A document shorter than an item is one window.

At similarity 0.8 the expected distance is 10 bits with a deviation of 3, so the radius lies more
than four deviations above it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetry.llm.common import SHINGLE_SIZE, SHINGLE_WORD, SIMILAR, WordHashes, mix, shingle_hashes, slices

RADIUS, BLOCKS, BITS = 23, 8, 64
#: Words of benchmark text that one pass over the documents holds; more items mean more passes.
ITEM_WORDS = 2_000_000


def _planes(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle."""
    bits = np.unpackbits(mix(shingles).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int8) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    """Fingerprints from sums over shingles, a tie counting as a set bit."""
    return np.packbits(sums >= 0, axis=1, bitorder="little")


def simhash(shingles: np.ndarray) -> np.ndarray:
    """The fingerprint of one weighted set, as eight bytes; a shingle counts as often as it is listed."""
    return _packed(_planes(shingles).sum(axis=0, dtype=np.int32)[None])[0]


_LOW = np.uint64((1 << 20) - 1)
_POPCOUNT = np.array([bin(x).count("1") for x in range(256)], dtype=np.uint8)


class Items:
    """Benchmark items, their fingerprints and the block tables."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.hashes = WordHashes()
        self.ids, self.sets, self.sizes, prints = [], [], [], []
        for item_id, text in rows:
            words = SHINGLE_WORD.findall(text.lower()) if text else []
            if not words:
                continue
            shingles = np.sort(shingle_hashes(self.hashes.of(words)))
            self.ids.append(item_id)
            self.sets.append(shingles)
            self.sizes.append(len(words))
            prints.append(simhash(shingles))
        self.prints = np.array(prints, np.uint8).reshape(-1, BITS // 8)
        self.size_of = np.array(self.sizes, np.int64)
        self.words, self.marks, self.known = {}, {}, {}
        for n in sorted(set(self.sizes)):
            mine = np.flatnonzero(self.size_of == n)
            self.words[n] = (mine, *self._postings(mine), self._tables(mine))
            # Shingles are of five words, but for items of fewer; texts are cut for each such size as well.
            self.marks.setdefault(min(SHINGLE_SIZE, n), np.zeros(1 << 20, bool))[self.words[n][1] & _LOW] = True
            old = self.known.get(min(SHINGLE_SIZE, n), np.zeros(0, np.uint64))
            self.known[min(SHINGLE_SIZE, n)] = np.union1d(old, self.words[n][1])

    def seen(self, shingles: np.ndarray, size: int) -> np.ndarray:
        """Positions of shingles that an item has: a bit table first passes over nearly all others."""
        may = np.flatnonzero(self.marks[size][shingles & _LOW])
        known = self.known[size]
        at = np.minimum(np.searchsorted(known, shingles[may]), len(known) - 1)
        return may[known[at] == shingles[may]]

    def _tables(self, mine: np.ndarray) -> np.ndarray:
        """For each block and each value of it, the items (as bits of a row) that lie near in this block."""
        near = RADIUS // BLOCKS
        values = np.arange(256, dtype=np.uint8)
        return np.stack([_POPCOUNT[values[:, None] ^ self.prints[mine, b][None]] <= near for b in range(BLOCKS)])

    def _postings(self, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct shingles of some items, where each one's list begins, and the items of all lists."""
        pairs = [(np.unique(self.sets[i]), k) for k, i in enumerate(mine)]
        shingles = np.concatenate([x for x, _ in pairs])
        owners = np.repeat([k for _, k in pairs], [len(x) for x, _ in pairs])
        order = np.lexsort((owners, shingles))
        known, first = np.unique(shingles[order], return_index=True)
        return known, np.append(first, len(order)), owners[order]

    def pairs(self, n: int, shingles: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and item, by its number among those of ``n`` words, of each shared shingle at places ``at``."""
        _, known, first, owners, _ = self.words[n]
        spot = np.minimum(np.searchsorted(known, shingles[at]), len(known) - 1)
        same = known[spot] == shingles[at]
        at, spot = at[same], spot[same]
        many = first[spot + 1] - first[spot]
        upto = np.cumsum(many)
        nth = np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - many, many)
        return np.repeat(at, many), owners[np.repeat(first[spot], many) + nth]

    def candidates(self, n: int, windows: np.ndarray, w: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs of window and item (by its number among those of ``n`` words), those within the radius."""
        mine, tables = self.words[n][0], self.words[n][-1]
        found = np.zeros(len(w), bool)
        for b in range(BLOCKS):
            found |= tables[b][windows[w, b], i]
        w, i = w[found], i[found]
        far = _POPCOUNT[windows[w] ^ self.prints[mine[i]]].sum(axis=1) > RADIUS
        return w[~far], mine[i[~far]]


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sets with counts, given as sorted arrays with repeats."""
    if len(a) == len(b) and (a == b).all():
        return 1.0
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = int(np.minimum(nx[i], ny[j]).sum())
    return common / (len(a) + len(b) - common)


def matches(text: str, items: Items, least: float = SIMILAR) -> dict[int, tuple[float, int, int]]:
    """Item -> similarity, first word and number of its best windows (the first of equals) in a text."""
    words = SHINGLE_WORD.findall(text.lower())
    best: dict[int, tuple[float, int, int]] = {}
    if not words:
        return best
    hashes = items.hashes.of(words)
    cuts = {size: shingle_hashes(hashes, size) for size in items.marks if size <= len(words)}
    seen = {size: items.seen(shingles, size) for size, shingles in cuts.items()}
    for n in items.words:
        size = min(SHINGLE_SIZE, n)
        if size not in cuts or not len(seen[size]):
            continue
        shingles, whole = cuts[size], n - size + 1
        per = min(whole, len(shingles))
        if per < least * whole:  # the text is too short for that similarity
            continue
        places, owners = items.pairs(n, shingles, seen[size])
        if not len(places):
            continue
        hit = np.zeros(len(shingles) + 1, np.int64)
        hit[places + 1] = 1
        upto = np.cumsum(hit)
        starts = np.flatnonzero(upto[per:] - upto[:-per] > 0)
        for lo in range(0, len(starts), 4096):  # memory stays the same however long the text is
            part = starts[lo : lo + 4096]
            first = part[0]
            sums = np.cumsum(_planes(shingles[first : part[-1] + per]), axis=0, dtype=np.int32)
            sums = np.concatenate((np.zeros((1, BITS), np.int32), sums))
            windows = _packed(sums[part - first + per] - sums[part - first])
            # Each shared shingle pairs its items with the windows around it.
            some = slice(np.searchsorted(places, first), np.searchsorted(places, part[-1] + per))
            low = np.maximum(np.searchsorted(part, places[some] - per + 1), 0)
            many = np.searchsorted(part, places[some], side="right") - low
            ends = np.cumsum(many)
            row = np.arange(ends[-1]) + np.repeat(low - (ends - many), many)
            shared = np.unique(row * len(items.words[n][0]) + np.repeat(owners[some], many))
            for w, i in zip(*items.candidates(n, windows, *np.divmod(shared, len(items.words[n][0]))), strict=True):
                s = int(part[w])
                score = weighted_jaccard(np.sort(shingles[s : s + per]), items.sets[i])
                item = items.ids[i]
                if score >= least:
                    old = best.get(item, (0.0, 0, 0))
                    best[item] = (max(old[0], score), s if score > old[0] else old[1], old[2] + 1)
    return best


def _scanned(rows, least: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    items = Items(rows.value)
    if not items.ids:
        return
    for batch in slices(batches):
        out = [
            (doc, item, *found)
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)
            if text
            for item, found in matches(text, items, least).items()
        ]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()), strict=True)],
                ["doc_id", "item_id", "similarity", "first_word", "windows"],
            )


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The query set in blocks of bounded text, read from the table one block at a time.

    An item is told from others by its id; null ids and texts have nothing to find.
    """
    items = benchmark.select(benchmark[item_id].cast("bigint").alias("i"), benchmark[text].cast("string").alias("t")).where("i is not null and t is not null")
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    count = total // (ITEM_WORDS * 5) + 1
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == k).distinct().collect()
        yield [tuple(r) for r in rows]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least: float = SIMILAR,
) -> DataFrame:
    """One row per document row and item that it holds: best similarity, its first word, windows that match.

    Null and empty texts hold nothing, items without words match nothing, an item id with two texts
    is matched by either, repeated document rows are reported as often. Texts are scanned whole.
    """
    spark = docs.sparkSession
    schema = "doc_id bigint, item_id bigint, similarity double, first_word bigint, windows bigint"
    source = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].cast("string").alias("text"))
    found = None
    for rows in _blocks(benchmark, item_id, item_text):
        sent = spark.sparkContext.broadcast(rows)
        part = source.mapInArrow(partial(_scanned, sent, least), schema)
        found = part if found is None else found.union(part)
    return found


def _clean(rows, least: float, column: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    items = Items(rows.value)
    for batch in batches:
        held = [bool(t and items.ids and matches(t, items, least)) for part in slices([batch]) for t in part.column(column).to_pylist()]
        yield batch.filter(pa.array([not h for h in held], pa.bool_()))


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least: float = SIMILAR,
) -> DataFrame:
    """``docs`` without those that hold an item.

    All rows of an id go if one of them holds an item; a row without id goes by its own text. Repeated
    rows share their verdict, null and empty texts stay, an empty table stays empty.
    """
    from haulmetry.llm.common import staged

    hits = contaminated(docs.where(docs[doc_id].isNotNull()), benchmark, doc_id, text, item_id, item_text, least)
    hits = staged(hits.select(F.col("doc_id").alias("_leak")).distinct(), "leaks")
    left = docs.where(docs[doc_id].isNotNull()).join(hits, F.col(doc_id) == F.col("_leak"), "left_anti")
    unnamed = docs.where(docs[doc_id].isNull())
    for rows in _blocks(benchmark, item_id, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(rows)
        unnamed = unnamed.mapInArrow(partial(_clean, sent, least, docs.columns.index(text)), docs.schema)
    return left.union(unnamed)
