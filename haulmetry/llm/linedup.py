"""Line deduplication across documents by pairwise alignment.

Two documents overlap if they share a run of consecutive lines of ``MIN_WORDS`` words or more. It is
enough to look at the least runs: for each line the shortest that starts there and the shortest that
ends there, since those inside a common block cover all of its lines. A run's holders are not paired
with each other: each later holder is paired with the first one, the document of the smallest id, so
a run costs one pair a holder, however many there are, and no run is too frequent to count. A pair
that several runs bring together is aligned once.

A pair is aligned with patience diff: lines that occur once in both documents anchor it, the longest
run of anchors in the same order stays, and the gaps are aligned in the same way. Runs of aligned
lines that are common blocks, of ``MIN_WORDS`` words or more, are deleted from the later document.
So are those that an alignment passes over, because they stand in another order or occur more often.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetry.llm.common import WORD, dropped, slices, staged

MIN_WORDS = 10


# Runs

#: Rolling hashes of runs: an odd number and its inverse, modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def least_runs(words: np.ndarray, first: np.ndarray, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """First and last line of each run of ``least`` words or more that is the shortest from its first or to its last line.

    ``words`` are those of the lines of several documents, of which ``first`` has the first lines.
    """
    at = np.arange(len(words))
    nth = np.searchsorted(first, at, side="right") - 1
    start, end = first[nth], np.append(first[1:], len(words))[nth]
    before, least = np.concatenate(([0], np.cumsum(words, dtype=np.int64))), max(least, 1)
    last = np.searchsorted(before, before[:-1] + least) - 1
    begin = np.searchsorted(before, before[1:] - least, side="right") - 1
    ahead, behind = last < end, begin >= start
    # A run that is the shortest either way is listed once.
    behind[behind] &= last[begin[behind]] != at[behind]
    return np.concatenate((at[ahead], begin[behind])), np.concatenate((last[ahead], at[behind]))


def run_hashes(lines: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of the lines of each run; that of a single line is the line's own."""
    with np.errstate(over="ignore"):
        power, back = (np.cumprod(np.append(np.uint64(1), np.full(len(lines), b, np.uint64)), dtype=np.uint64) for b in (_BASE, _BACK))
        sums = np.append(np.uint64(0), np.cumsum(lines.astype(np.uint64) * power[:-1], dtype=np.uint64))
        return (sums[last + 1] - sums[first]) * back[first]


def _runs(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 256):
        lines, words = batch.column(1), batch.column(2).flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(lines.value_lengths().to_numpy(zero_copy_only=False))
        first, last = least_runs(words, np.append(0, starts[:-1]), least)
        hashes = run_hashes(lines.flatten().to_numpy(zero_copy_only=False), first, last)
        key = batch.column(0).take(pa.array(np.searchsorted(starts, first, side="right")))
        yield pa.RecordBatch.from_arrays([key, pa.array(hashes.view(np.int64))], ["key", "run"])


# Alignment


def _ordered(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence whose second places ascend; first places ascend already."""
    tops: list[int] = []
    ends: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        back[k] = ends[at - 1] if at else -1
        if at == len(tops):
            tops.append(b)
            ends.append(k)
        else:
            tops[at], ends[at] = b, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _anchors(a: list, b: list) -> list[tuple[int, int]]:
    """Places of lines that occur once in both; if there are none, of the same occurrence of a line."""
    in_a, in_b = Counter(a), Counter(b)
    place = {x: k for k, x in enumerate(b) if in_b[x] == 1}
    found = [(k, place[x]) for k, x in enumerate(a) if in_a[x] == 1 and x in place]
    if found or not in_a.keys() & in_b.keys():
        return found

    def numbered(lines: list) -> list:
        seen: Counter = Counter()
        out = []
        for x in lines:
            out.append((x, seen[x]))
            seen[x] += 1
        return out

    place = {x: k for k, x in enumerate(numbered(b))}
    return [(k, place[x]) for k, x in enumerate(numbered(a)) if x in place]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of places of equal lines, ascending in both."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        at = (a0, b0)
        for x, y in _ordered(_anchors(a[a0:a1], b[b0:b1])):
            x, y = x + a0, y + b0
            found.append((x, y))
            todo.append((at[0], x, at[1], y))
            at = (x + 1, y + 1)
        if at != (a0, b0):
            todo.append((at[0], a1, at[1], b1))
    return sorted(found)


def common_blocks(earlier: list, later: list, words: list[int], least: int = MIN_WORDS) -> list[tuple[int, int]]:
    """First line and number of lines of each block of the later document, of ``least`` words or more.

    Blocks of the alignment come first, then what common runs add to them.
    """
    out, run = [], []
    for pair in [*patience(earlier, later), None]:
        if run and (pair is None or pair != (run[-1][0] + 1, run[-1][1] + 1)):
            first, last = run[0][1], run[-1][1]
            if sum(words[first : last + 1]) >= least:
                out.append((first, last - first + 1))
            run = []
        if pair is not None:
            run.append(pair)
    return out + _passed_over(earlier, later, words, least, out)


def _passed_over(earlier: list, later: list, words: list[int], least: int, found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Blocks of lines outside those found, in runs that both documents hold wherever they stand."""
    gone, shared = [False] * len(later), set(earlier)
    for at, n in found:
        gone[at : at + n] = [True] * n
    if not any(w and not g and x in shared for x, w, g in zip(later, words, gone, strict=True)):
        return []
    # Runs with a line that is left, all of them lines of the earlier document.
    bad = np.cumsum([0, *(x not in shared for x in later)])
    left = np.cumsum([0, *(bool(w) and not g for w, g in zip(words, gone, strict=True))])
    alone = np.zeros(1, np.int64)
    first, last = least_runs(np.array(words, np.int64), alone, least)
    some = (bad[last + 1] == bad[first]) & (left[last + 1] > left[first])
    if not some.any():
        return []
    # A line that only the earlier document has breaks its runs off.
    count = dict(zip(later, words, strict=True))
    runs = zip(*(x.tolist() for x in least_runs(np.array([count.get(x, least) for x in earlier], np.int64), alone, least)), strict=True)
    known = {tuple(earlier[a : b + 1]) for a, b in runs}
    held = [False] * len(later)
    for a, b in zip(first[some].tolist(), last[some].tolist(), strict=True):
        if tuple(later[a : b + 1]) in known:
            held[a : b + 1] = [True] * (b + 1 - a)
    more = np.array(held) & ~np.array(gone)
    edges = np.flatnonzero(np.diff(np.concatenate(([False], more, [False])).astype(np.int8))).tolist()
    return [(a, b - a) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _aligned(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))
    for batch in slices(batches, 256):
        later, words, earlier = (batch.column(k).to_pylist() for k in (2, 3, 4))
        found = [
            [{"at": at, "n": n} for at, n in common_blocks(a, b, w, least)]
            for a, b, w in zip(earlier, later, words, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, kind)], ["later", "earlier", "blocks"]
        )


# Over a corpus


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = MIN_WORDS) -> DataFrame:
    """Each document row with what is left of it: ``doc_id``, ``n_lines``, ``n_removed``, ``partners``, ``text``.

    No line with words is left in a block of ``least`` words or more that an earlier document holds.
    Lines are compared without white space at their ends; lines without words are never a reason to
    pair or to delete, but go with the block around them. ``partners`` are the ids of documents that
    removed blocks are aligned with, ascending. A null text has one empty line. Rows of one id and
    one text are treated alike and keep their lines from each other; rows of one id and different
    texts are different documents, in the order of a digest of the text; null ids come before all.
    """
    d = docs.select(docs[doc_id].cast("bigint").alias("id"), docs[text].cast("string").alias("text"))
    d = d.withColumn("key", F.struct("id", F.xxhash64("text").alias("h")))
    trimmed = F.transform(_lines(F.col("text")), lambda x: F.regexp_replace(x, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""))
    rows = staged(
        d.select("key", trimmed.alias("l"))
        .select(
            "key",
            F.transform("l", lambda x: F.xxhash64(x)).alias("lines"),
            F.transform("l", lambda x: F.regexp_count(x, F.lit(WORD))).alias("words"),
        )
        .dropDuplicates(["key"]),
        "lines",
    )
    each = rows.mapInArrow(partial(_runs, least), "key struct<id:bigint,h:bigint>, run bigint")
    holders = each.groupBy("run").agg(F.min("key").alias("earlier"), F.max("key").alias("last")).where("earlier != last")
    pairs = staged(
        each.join(holders.select("run", "earlier"), "run").where("key != earlier").select(F.col("key").alias("later"), "earlier").distinct(),
        "pairs",
    )
    later = rows.select(F.col("key").alias("later"), F.col("lines").alias("b"), F.col("words").alias("bw"))
    earlier = rows.select(F.col("key").alias("earlier"), F.col("lines").alias("a"))
    keys = "later struct<id:bigint,h:bigint>, earlier struct<id:bigint,h:bigint>"
    blocks = (
        pairs.join(later, "later")
        .join(earlier, "earlier")
        .select("later", "earlier", "b", "bw", "a")
        .mapInArrow(partial(_aligned, least), f"{keys}, blocks array<struct<at:int,n:int>>")
        .where(F.size("blocks") > 0)
        .groupBy(F.col("later").alias("key"))
        # A document has no more partners than least runs, two a line.
        .agg(F.array_distinct(F.flatten(F.collect_list("blocks"))).alias("blocks"), F.array_sort(F.collect_set("earlier.id")).alias("partners"))
    )
    blocks = staged(blocks, "blocks")
    dropped(pairs)
    cut = F.coalesce("blocks", F.array().cast("array<struct<at:int,n:int>>"))
    inside = lambda i: F.exists(cut, lambda x: (i >= x["at"]) & (i < x["at"] + x["n"]))
    lines = _lines(F.col("text"))
    left = F.when(F.size(cut) > 0, F.filter(lines, lambda x, i: ~inside(i))).otherwise(lines)
    return (
        d.join(blocks, "key", "left")
        .select(F.col("id").alias("doc_id"), F.size(lines).alias("n_lines"), left.alias("left"), "partners")
        .select(
            "doc_id",
            "n_lines",
            (F.col("n_lines") - F.size("left")).alias("n_removed"),
            F.coalesce("partners", F.array().cast("array<bigint>")).alias("partners"),
            F.array_join("left", "\n").alias("text"),
        )
    )
