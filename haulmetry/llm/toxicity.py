"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Each word is toxic or not. The field scores a word by hashed features (the word, its beginning and
end, the words before and after) and by the label of the word before it. Forward-backward gives each
word's marginal; a document's score is a logistic function of the expected number of toxic words and
of the surest one; words with a marginal of more than a half are its offending offsets.

Training words are labelled from document labels: words that are far more frequent in toxic documents,
and not because one text was copied, are toxic there. Gradients of the likelihood are
summed over the partitions of the training documents, one Spark job a step.

Forward-backward has two states, so a word is a 2 x 2 matrix. Texts of a batch are one chain that
starts anew at each text; the chain is cut into blocks whose matrices are multiplied side by side.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetry.llm.common import dropped, remainder, slices, staged

WORD = re.compile(r"[^\W\d_]+")
#: Weights; their number is fixed, so the model's size is.
BUCKETS = 1 << 17
#: Documents to learn from: labelled rows are kept by a digest of their id, about so many at most.
LABELLED = 8_000
STEPS = 14
FOLDS = 5
_KINDS = 5
_BLOCK = 64


# Features


def _bucket(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}:{value}".encode("utf-8", "surrogatepass")) % BUCKETS


class Words(dict):
    """A word's place in ``ids``, which has the buckets of its features: itself, start, end, as last and as next word."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.ids = np.zeros((most, _KINDS), np.int32)
        self.values = np.zeros((most, 3))
        self.weights: np.ndarray | None = None

    def __missing__(self, word: str) -> int:
        if len(self) >= len(self.ids):
            raise OverflowError
        low = word.lower()
        k = self[word] = len(self)
        ids = self.ids[k] = [_bucket("w", low), _bucket("s", low[:4]), _bucket("e", low[-4:]), _bucket("b", low), _bucket("a", low)]
        if self.weights is not None:
            w = self.weights[ids]
            self.values[k] = w[0] + w[1] + w[2], w[3], w[4]
        return k

    def of(self, words: list[str]) -> np.ndarray:
        try:
            return np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        except OverflowError:
            self.clear()
            if len(set(words)) > len(self.ids):
                self.ids = np.zeros((len(words), _KINDS), np.int32)
                self.values = np.zeros((len(words), 3))
            return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def _first(counts: np.ndarray) -> np.ndarray:
    """Whether a word is its text's first, for texts of so many words."""
    first = np.zeros(int(counts.sum()) + 1, bool)
    first[np.cumsum(counts) - counts] = True
    return first[:-1]


def _around(value: np.ndarray, first: np.ndarray, step: int) -> np.ndarray:
    """Each word's value of the word before (-1) or after (1) it, 0 outside the text."""
    out = np.zeros_like(value)
    if step < 0:
        out[1:] = value[:-1]
        out[first] = 0
    else:
        out[:-1] = value[1:]
        out[:-1][first[1:]] = 0
        out[-1:] = 0
    return out


# Forward and backward


def chain(scores: np.ndarray, first: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of the second label from the words up to each word, and from the words after it.

    ``scores`` are log weights of the second label over the first, ``moves`` the logarithms of the
    2 x 2 weights of one label after another. Exact, but for scores beyond 30.
    """
    n = len(scores)
    blocks = -(-n // _BLOCK)
    size = blocks * _BLOCK
    e, start = np.ones(size), np.ones(size, bool)
    e[:n], start[:n] = np.exp(np.clip(scores, -30, 30)), first
    t = np.exp(moves)
    # The matrix of each word; at a text's first word both rows are alike, so nothing comes through.
    m = np.empty((4, _BLOCK, blocks))
    for k, (i, j) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
        value = np.where(start, 1.0, t[i, j])
        m[k] = (value * e if j else value).reshape(blocks, _BLOCK).T
    a, b, c, d = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)
    for x in range(_BLOCK):
        p, q, r, s = m[:, x]
        a, b, c, d = a * p + b * r, a * q + b * s, c * p + d * r, c * q + d * s
        if x % 8 == 7:
            scale = 1.0 / (a + b + c + d)
            a, b, c, d = a * scale, b * scale, c * scale, d * scale
    into, after = np.empty(blocks), np.empty(blocks)
    odds = 1.0
    for k, (p, q, r, s) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist(), strict=True)):
        into[k] = odds
        odds = (q + odds * s) / (p + odds * r)
    odds = 1.0
    for k, (p, q, r, s) in enumerate(zip(a.tolist()[::-1], b.tolist()[::-1], c.tolist()[::-1], d.tolist()[::-1], strict=True)):
        after[blocks - 1 - k] = odds
        odds = (r + s * odds) / (p + q * odds)
    ahead, behind = np.empty((_BLOCK, blocks)), np.empty((_BLOCK, blocks))
    for x in range(_BLOCK):
        p, q, r, s = m[:, x]
        into = (q + into * s) / (p + into * r)
        ahead[x] = into
    for x in range(_BLOCK - 1, -1, -1):
        behind[x] = after
        p, q, r, s = m[:, x]
        after = (r + s * after) / (p + q * after)
    return np.log(ahead.T.reshape(-1)[:n]), np.log(behind.T.reshape(-1)[:n])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -50, 50)))


# Training


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 512):
        hits, every = Counter(), Counter()
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = {w.lower() for w in WORD.findall(text or "")}
            every.update(words)
            if toxic:
                hits.update(words)
        names = list(every)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array([hits[w] for w in names], pa.int64()), pa.array([every[w] for w in names], pa.int64())],
            ["word", "toxic", "docs"],
        )


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each different word of some texts with each word that it follows; a text's first word follows the empty one."""
    for batch in slices(batches, 64):
        found: set[tuple[str, str]] = set()
        for text in batch.column(0).to_pylist():
            words = [w.lower() for w in WORD.findall(text or "")]
            found.update(zip(words, ["", *words], strict=False))
        pairs = list(found)
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], ["word", "before"])


def toxic_words(train: DataFrame, odds: float = 3.0, least: int = 5, share: float = 0.02) -> set[str]:
    """Words that label the training words; ``train`` has ``text`` and ``toxic``.

    A word's log odds of being in a toxic document must be ``odds`` or more, and it must follow
    different words in the toxic documents, at least ``least`` and that share of their number: the
    words of one toxic text that was copied always follow the same. Both are counted on the cluster;
    the words found come back, all of them, and are no more than the toxic documents of the sample hold.
    Repeated rows count each time in the odds, once in what a word follows; null and empty texts have
    no words; without documents of both kinds there are none.
    """
    totals = train.agg(F.count("*").alias("n"), F.sum("toxic").alias("p")).first()
    n, p = totals["n"], totals["p"] or 0
    if not p or p == n:
        return set()
    counts = train.mapInArrow(_tallied, "word string, toxic bigint, docs bigint").groupBy("word").agg(F.sum("toxic").alias("t"), F.sum("docs").alias("d"))
    ratio = F.log((F.col("t") + 0.5) / (p + 1)) - F.log((F.col("d") - F.col("t") + 0.5) / (n - p + 1))
    likely = counts.where(F.col("t") >= least).where(ratio >= odds).select("word")
    before = train.where("toxic = 1").select("text").mapInArrow(_followed, "word string, before string")
    places = before.join(likely, "word").groupBy("word").agg(F.count_distinct("before").alias("n"))
    return {r["word"] for r in places.where(F.col("n") >= max(least, share * p)).collect()}


def _gradients(sent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum over a partition of observed less expected features, for features and moves that occur."""
    weights, moves, seeds = sent.value
    grad, pairs = np.zeros(BUCKETS), np.zeros((2, 2))
    words = Words()
    for batch in slices(batches, 256):
        texts = [WORD.findall(t or "") for t in batch.column(0).to_pylist()]
        counts = np.array([len(t) for t in texts], np.int64)
        every = [w for t in texts for w in t]
        if not every:
            continue
        at, first = words.of(every), _first(counts)
        ids = words.ids[at].astype(np.int64)
        before, after = _around(ids[:, 3] + 1, first, -1) - 1, _around(ids[:, 4] + 1, first, 1) - 1
        use = np.column_stack((ids[:, :3], before, after))
        scores = np.where(use >= 0, weights[use], 0.0).sum(axis=1)
        toxic = np.repeat(np.array([bool(t) for t in batch.column(1).to_pylist()]), counts)
        label = toxic & np.fromiter((w.lower() in seeds for w in every), bool, len(every))
        a, b = chain(scores, first, moves)
        gap = label - _sigmoid(a + b)
        for k in range(_KINDS):
            ok = use[:, k] >= 0
            grad += np.bincount(use[ok, k], gap[ok], BUCKETS)
        inner = np.flatnonzero(~first)
        if len(inner):
            last = np.column_stack((np.zeros(len(inner)), a[inner - 1]))
            here = np.column_stack((np.zeros(len(inner)), scores[inner] + b[inner]))
            z = last[:, :, None] + moves + here[:, None, :]
            z = np.exp(z - z.max(axis=(1, 2), keepdims=True))
            pairs -= (z / z.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            np.add.at(pairs, (label[inner - 1].astype(int), label[inner].astype(int)), 1.0)
    full = np.concatenate((grad, pairs.reshape(-1)))
    some = np.flatnonzero(full)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(full[some])], ["feature", "gradient"])


def fit(train: DataFrame, steps: int = STEPS, penalty: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and moves, by resilient gradient steps on the whole of ``train`` (``text``, ``toxic``)."""
    spark = train.sparkSession
    seeds = toxic_words(train)
    size = BUCKETS + 4
    theta, pace, last = np.zeros(size), np.full(size, 0.4), np.zeros(size)
    if not seeds:
        return theta[:BUCKETS], theta[BUCKETS:].reshape(2, 2)
    for _ in range(steps):
        sent = spark.sparkContext.broadcast((theta[:BUCKETS], theta[BUCKETS:].reshape(2, 2), seeds))
        parts = train.mapInArrow(partial(_gradients, sent), "feature bigint, gradient double")
        # At most one number a weight comes back.
        summed = parts.groupBy("feature").agg(F.sum("gradient").alias("g")).toArrow()
        gradient = -penalty * theta
        gradient[summed["feature"].to_numpy()] += summed["g"].to_numpy()
        same = np.sign(gradient) * np.sign(last)
        pace = np.clip(np.where(same > 0, pace * 1.3, np.where(same < 0, pace * 0.5, pace)), 1e-3, 2.0)
        last = np.where(same < 0, 0.0, gradient)
        theta = np.clip(theta + np.sign(last) * pace, -20, 20)
        sent.unpersist()
    return theta[:BUCKETS], theta[BUCKETS:].reshape(2, 2)


# Scoring


def _features(weights: np.ndarray, moves: np.ndarray, words: Words, texts: list[str | None]) -> tuple[np.ndarray, list[str]]:
    """Per text the log expected number of toxic words and the surest one's log odds; and offending offsets."""
    out = np.column_stack((np.zeros(len(texts)), np.full(len(texts), -12.0)))
    spans = [""] * len(texts)
    cut = [WORD.findall(t) if t else [] for t in texts]
    counts = np.array([len(c) for c in cut], np.int64)
    if not counts.sum():
        return out, spans
    at, first = words.of([w for c in cut for w in c]), _first(counts)
    values = words.values[at]
    scores = values[:, 0] + _around(values[:, 1], first, -1) + _around(values[:, 2], first, 1)
    a, b = chain(scores, first, moves)
    logit = a + b
    some = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[some]
    out[some, 0] = np.log1p(np.add.reduceat(_sigmoid(logit), starts))
    out[some, 1] = np.clip(np.maximum.reduceat(logit, starts), -12, 12)
    for k in some[out[some, 1] > 0]:
        start = int(counts[:k].sum())
        places = np.flatnonzero(logit[start : start + counts[k]] > 0).tolist()
        at = [m.span() for m in WORD.finditer(texts[k])]
        spans[k] = ",".join(f"{at[n][0]}:{at[n][1]}" for n in places)
    return out, spans


def _scored(sent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    weights, moves, scale = sent.value
    words = Words()
    words.weights = weights
    for batch in slices(batches, 256):
        x, spans = _features(weights, moves, words, batch.column(0).to_pylist())
        score = _sigmoid(np.column_stack((np.ones(len(x)), x)) @ scale)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(score), pa.array(spans)],
            [*batch.schema.names[1:], "x0", "x1", "score", "spans"],
        )


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's steps for a logistic function of two features of the training documents."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = _sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.clip(np.linalg.solve(h, x.T @ (y - p) - ridge * w), -4, 4)
    return w


def toxicity(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", labelled: int = LABELLED
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``spans`` (``start:end`` in code points) per document row.

    Learns from labelled documents outside the held-out fold, about ``labelled`` at most. A document
    is toxic if any of its label rows says so; null labels and ids say nothing. Texts that are null
    or have no words get the score of texts without toxic words. Where no word tells toxic documents
    from others, for want of labels of both kinds or otherwise, every score is the rate of toxic ones.
    """
    spark = docs.sparkSession
    known = (
        labels.select(labels[doc_id].cast("bigint").alias("id"), labels[label].cast("int").alias("toxic"))
        .where("id is not null and toxic is not null")
        .where(remainder(F.col("id"), FOLDS) != 0)
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n = known.count()
    share = min(1.0, labelled / n) if n else 0.0
    chosen = staged(known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000)), "labelled")
    source = docs.select(docs[text].cast("string").alias("text"), docs[doc_id].cast("bigint").alias("doc_id"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    train = staged(
        source.join(chosen, source["doc_id"] == chosen["id"]).select("text", "toxic").repartition(min(parts, 24)), "train"
    )
    weights, moves = fit(train)
    sent = spark.sparkContext.broadcast((weights, moves, np.zeros(3)))
    rows = train.mapInArrow(partial(_scored, sent), "toxic int, x0 double, x1 double, score double, spans string").select("toxic", "x0", "x1").toArrow()
    y = rows["toxic"].to_numpy()
    if weights.any():
        scale = _logistic(np.column_stack((rows["x0"].to_numpy(), rows["x1"].to_numpy())), y)
    else:
        rate = float(np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6))
        scale = np.array([np.log(rate / (1 - rate)), 0.0, 0.0])
    dropped(train)
    final = spark.sparkContext.broadcast((weights, moves, scale))
    scored = source.mapInArrow(partial(_scored, final), "doc_id bigint, x0 double, x1 double, score double, spans string")
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "spans",
    )
