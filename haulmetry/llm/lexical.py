"""Ranked lexical search of whole documents for a set of items, by one Aho-Corasick scan and no index.

An automaton of all terms of the items, each guarded by a boundary on either side, runs over every
text and counts each term's occurrences. Documents are written as their counts; document frequencies
and lengths are sums over that table, and scores follow from it in integers. A task keeps the best
documents of each item that it has seen, so only those are shuffled.

Items are taken in blocks of bounded text, one scan a block: the automaton and what it maps to are the
only things sent to tasks.
"""

from __future__ import annotations

import math
import operator
import string
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmetry.llm.common import slices, staged

#: What a term is made of, and how its occurrences and a text's length weigh.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BEST = 10
_SCALE, _GAIN, _DAMP, _LENGTH_SHARE = 1_000_000_000, 1000, 8, 90

#: Characters of items in a block. An item is never split, so its own terms must fit in a task.
ITEM_TEXT = 1 << 20
#: Scores held at a time: documents of a slice times items.
_HELD = 4_000_000

# As bytes of UTF-8: what separates terms becomes a space, capital letters small ones, others stay.
_KEEP = (string.ascii_letters + string.digits).encode()
_FOLD = bytes(b if b >= 0x80 else bytes([b]).lower()[0] if b in _KEEP else 0x20 for b in range(256))

_COUNTS = "doc_id bigint, n bigint, terms array<int>, counts array<bigint>"
_RANKED = "item_id bigint, doc_id bigint, score bigint"


def terms_of(text: Column) -> Column:
    """All terms of a text, with repeats."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))


class Automaton:
    """Counts a fixed list of terms in texts."""

    def __init__(self, terms: list[str]):
        import ahocorasick

        self._found = ahocorasick.Automaton()
        for k, term in enumerate(terms):
            self._found.add_word(f" {term.encode().decode('latin-1')} ", k)
        self._found.make_automaton()
        self._any = bool(terms)

    def counts(self, text: bytes | None) -> tuple[int, np.ndarray, np.ndarray]:
        """Terms in a text (UTF-8), and which of the list it holds how often."""
        folded = b" " + (text or b"").translate(_FOLD) + b" "
        inside = np.frombuffer(folded, np.uint8) != 0x20
        total = int(np.count_nonzero(inside[1:] & ~inside[:-1]))
        if not total or not self._any:
            return total, np.zeros(0, np.int32), np.zeros(0, np.int64)
        # One character a byte: terms were encoded alike. A boundary ends one match and begins the next.
        hits = map(operator.itemgetter(1), self._found.iter(folded.decode("latin-1")))
        found, times = np.unique(np.fromiter(hits, np.int32), return_counts=True)
        return total, found, times


_built: tuple[list[str], Automaton] | None = None


def _automaton(terms: list[str]) -> Automaton:
    """The automaton of a broadcast list, built once in a Python worker."""
    global _built
    if _built is None or _built[0] is not terms:
        _built = terms, Automaton(terms)
    return _built[1]


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts), kind))


def _counted(sent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = _automaton(sent.value)
    for batch in slices(batches, 128):
        totals, found, times = zip(*(automaton.counts(t) for t in batch.column(1).cast(pa.binary()).to_pylist()), strict=True)
        columns = [batch.column(0), pa.array(totals, pa.int64()), _lists(list(found), pa.int32()), _lists(list(times), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])


class Scorer:
    """Scores of counted documents for all items of a block."""

    def __init__(self, weights: np.ndarray, first: np.ndarray, items: np.ndarray, documents: int, length: int):
        self.weights, self.first, self.items = weights, first, items
        self.documents, self.length = documents, length
        self.count = int(items.max()) + 1 if len(items) else 0

    def scores(self, n: list[int], held: np.ndarray, terms: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Documents by items; ``held`` is how many of ``terms`` belong to each document."""
        m = np.array([100 - _LENGTH_SHARE + _LENGTH_SHARE * k * self.documents // self.length for k in n], np.int64)
        doc = np.repeat(np.arange(len(n)), held)
        gain = self.weights[terms] * ((_SCALE * tf) // (_GAIN * tf + _DAMP * m[doc]))
        # Each term's gain goes to all items that have it.
        many = (self.first[1:] - self.first[:-1])[terms]
        upto = np.cumsum(many)
        at = np.arange(upto[-1] if len(upto) else 0) + np.repeat(self.first[terms] - (upto - many), many)
        total = np.zeros(len(n) * self.count, np.int64)
        np.add.at(total, np.repeat(doc, many) * self.count + self.items[at], np.repeat(gain, many))
        return total.reshape(len(n), self.count)


class Best:
    """The best ``k`` documents of each item so far: by score, then by id, those without id last."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.rows = tuple(np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))

    def add(self, scores: np.ndarray, ids: np.ndarray, unset: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.least)
        if not len(doc):
            return
        new = (item, scores[doc, item], unset[doc], ids[doc])
        item, score, none, ident = (np.concatenate(pair) for pair in zip(self.rows, new, strict=True))
        order = np.lexsort((ident, none, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[place < self.k]
        self.rows = tuple(c[kept] for c in (np.concatenate((self.rows[0], new[0])), score, none, ident))
        last = order[place == self.k - 1]
        self.least[item[place == self.k - 1]] = score[last]


def _scored(sent, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, model = sent.value
    scorer = Scorer(*model)
    best = Best(scorer.count, k)
    for batch in slices(batches, max(1, min(500, _HELD // max(1, scorer.count)))):
        ids, n, terms, counts = (batch.column(c) for c in range(4))
        held = np.diff(terms.offsets.to_numpy())
        scores = scorer.scores(n.to_pylist(), held, terms.flatten().to_numpy(), counts.flatten().to_numpy())
        best.add(scores, ids.fill_null(0).to_numpy(), np.asarray(ids.is_null()))
    item, score, none, ident = best.rows
    named = pa.array(names, pa.int64()).take(pa.array(item))
    yield pa.RecordBatch.from_arrays([named, pa.array(ident, pa.int64(), mask=none), pa.array(score)], ["item_id", "doc_id", "score"])


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """Distinct (item, term) of a block of items; the block's text is bounded, not its number of items."""
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = total // ITEM_TEXT + 1
    pairs = items.select("item_id", F.explode(terms_of(F.col("text"))).alias("term")).distinct()
    for k in range(count):
        yield [tuple(r) for r in pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == k).collect()]


def ranked(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: each item's best documents, those with a score above 0.

    Every row of ``docs`` is a document, repeated ones and those without id too; of equal scores the
    smaller id comes first, a missing one last. Null and empty texts have no terms and are not counted.
    Rows of one item id are one item with the terms of all its texts, rows without id likewise. An item
    without terms, or whose terms no document holds, has no rows; so has an empty table.
    """
    spark = docs.sparkSession
    source = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].cast("string").alias("text"))
    asked = items.select(items[item_id].cast("bigint").alias("item_id"), items[item_text].cast("string").alias("text"))
    found, sums = None, None
    for pairs in _blocks(asked):
        terms = sorted({t for _, t in pairs})
        names = sorted({i for i, _ in pairs}, key=lambda i: (i is None, i or 0))
        nth = {t: k for k, t in enumerate(terms)}
        place = {i: k for k, i in enumerate(names)}
        counted = staged(source.mapInArrow(partial(_counted, spark.sparkContext.broadcast(terms)), _COUNTS), "counts")
        if sums is None:
            sums = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        frequency = np.zeros(len(terms), np.int64)
        for term, count in held:
            frequency[term] = count
        weights = [math.floor(1000 * math.log((2 * sums[0] + 2) / (2 * df + 1))) for df in frequency.tolist()]
        postings = sorted((nth[t], place[i]) for i, t in pairs)
        first = np.searchsorted([t for t, _ in postings], np.arange(len(terms) + 1))
        model = (np.array(weights, np.int64), first, np.array([i for _, i in postings], np.int64), sums[0], max(1, sums[1]))
        sent = spark.sparkContext.broadcast((names, model))
        part = counted.where(F.size("terms") > 0).mapInArrow(partial(_scored, sent, best), _RANKED)
        found = part if found is None else found.union(part)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    numbered = found.withColumn("rank", F.row_number().over(order))
    return numbered.where(F.col("rank") <= best).select("item_id", "rank", "doc_id", "score")
