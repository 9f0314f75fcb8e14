"""A hashed maximum-entropy language model with a class-factored softmax.

A token is predicted in two steps, its class and then itself in its class, from features of the tokens
before it: the last one, the two before that (skips), and a hash of the last two. The ``HEAD`` most
frequent training tokens are in classes of ``WIDE``, and a softmax over the same features chooses in
them. All other tokens are in ``TAIL`` classes by their ending, inside which each has its smoothed
share of the training tokens; a class keeps a share for tokens it has never seen, so probabilities sum
to 1.

Training passes over all training documents once, in ``ROUNDS`` parts. In a round every partition
starts from the same weights and takes gradient steps over its own documents in sparse numpy batches;
the weights are then averaged by tokens, block by block, on the cluster. What comes back to the driver
is one model of fixed size, while what is shuffled grows with the partitions.

Counts of all training tokens stay a table. The most frequent ``KNOWN`` of them, a fixed bound, are
sent to the scoring tasks; the others meet their counts in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetry.llm.common import remainder, slices, staged

FOLDS = 10
HEAD, WIDE, TAIL = 512, 32, 48
KNOWN = 1 << 19
HASHED = 1 << 12
ROUNDS = 3
RATES = (0.5, 0.25, 0.12)
BATCH = 8192
#: Scores up to here need no lowering before their exponentials are added.
FAR = 60.0
#: Tokens scored at a time: their numbers stay in a core's cache.
CACHED = 1024
#: The end of a document; no word is a space.
END = b" "
SMOOTH = 0.1

_CLASSES = HEAD // WIDE + TAIL
_SYMBOLS = HEAD + TAIL + 1  # and what stands before a document
_NONE = _SYMBOLS - 1
_ROWS1 = _ROWS2 = 1 + 3 * _SYMBOLS + HASHED
_SIZE1, _SIZE2 = _ROWS1 * _CLASSES, _ROWS2 * HEAD
_BLOCKS = 32


def tokens(text: str | None) -> list[bytes]:
    """Words in lower-case letters A to Z, and the end."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def _hash(token: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(token) - (1 << 63)


def _ending(token: bytes) -> int:
    return int.from_bytes(token[-2:], "little")


def _hashes(tokens: list[bytes]) -> np.ndarray:
    """``_hash`` of many."""
    import xxhash

    found = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
    return (found ^ np.uint64(1 << 63)).view(np.int64)


def _endings(tokens: list[bytes]) -> np.ndarray:
    """``_ending`` of many; a single byte is followed by a zero."""
    return np.array([t[-2:] for t in tokens], "S2").view("<u2")


# Counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(_hashes(list(counts)), pa.int64()),
                pa.array(_endings(list(counts)).astype(np.int32), pa.int32()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            ["h", "ending", "c"],
        )

    counts: Counter = Counter()
    for batch in slices(batches, 64):
        for text in batch.column(0).to_pylist():
            counts.update(tokens(text))
        if len(counts) > 200_000:
            yield rows(counts)
            counts = Counter()
    yield rows(counts)


def token_counts(train: DataFrame) -> DataFrame:
    """Digest, ending and count of every token of the training texts, staged."""
    parts = train.mapInArrow(_counted, "h bigint, ending int, c bigint")
    return staged(parts.groupBy("h").agg(F.first("ending").alias("ending"), F.sum("c").alias("c")), "counts")


class Lexicon:
    """What tasks need to know of the counts; its size is bounded by ``KNOWN``."""

    def __init__(self, counts: DataFrame):
        total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
        self.n, self.v = total["n"] or 0, total["v"]
        first = counts.orderBy(F.desc("c"), "h").limit(HEAD).select("h", "c").collect()
        self.head = np.array([r["h"] for r in first], np.int64)
        self.head_counts = np.zeros(HEAD)
        self.head_counts[: len(first)] = [r["c"] for r in first]
        # Tokens from the count on at which they are no more than KNOWN: by size classes of counts.
        step = F.floor(F.log2("c") * 16).cast("int").alias("step")
        least, seen = None, 0
        for r in counts.groupBy(step).agg(F.count("*").alias("v"), F.min("c").alias("c")).orderBy(F.desc("step")).collect():
            seen += r["v"]
            if seen > KNOWN:
                break
            least = r["c"]
        known = counts.where(F.col("c") >= least) if least else counts.limit(0)
        h, c = (x.to_numpy() for x in known.select("h", "c").toArrow().columns)
        order = np.argsort(h)
        self.h, self.c = h[order], c[order].astype(np.float64)
        tail = counts.where(~F.col("h").isin([int(x) for x in self.head])) if len(self.head) else counts
        ends = tail.groupBy("ending").agg(F.sum("c").alias("n"), F.count("*").alias("v")).orderBy(F.desc("n"), "ending")
        # Endings are at most 65,536.
        rows = ends.collect()
        self.tail_of = {r["ending"]: k for k, r in enumerate(rows[: TAIL - 1])}
        self.tail_n, self.tail_v = np.zeros(TAIL), np.zeros(TAIL)
        for r in rows:
            k = self.tail_of.get(r["ending"], TAIL - 1)
            self.tail_n[k] += r["n"]
            self.tail_v[k] += r["v"]
        self.share = np.log10(self.tail_n + SMOOTH * (self.tail_v + 1))

    def log_c(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logarithm of the smoothed count of each digest, and whether it is known here."""
        if not len(self.h):
            return np.zeros(len(h)), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return np.log10(self.c[at] + SMOOTH), self.h[at] == h


class Symbols(dict):
    """Tokens as places in ``h`` (digests), ``symbol`` (number in the head, or tail class behind it), ``log_c``
    and ``here`` (of the lexicon), so that a token is looked up once and not each time it stands."""

    def __init__(self, lexicon: Lexicon, most: int = 200_000):
        super().__init__()
        self.lexicon = lexicon
        order = np.argsort(lexicon.head)
        self.head, self.rank = lexicon.head[order], order.astype(np.int64)
        self.by_ending = np.full(1 << 16, HEAD + TAIL - 1, np.int64)
        for ending, k in lexicon.tail_of.items():
            self.by_ending[ending] = HEAD + k
        self._make(most)

    def _make(self, most: int) -> None:
        self.clear()
        self.h, self.symbol, self.log_c, self.here = (np.zeros(most, t) for t in (np.int64, np.int64, np.float64, bool))

    def _put(self, new: list[bytes]) -> None:
        """Places for tokens that have none, all at once."""
        first = len(self)
        self.update(zip(new, range(first, first + len(new)), strict=True))
        h, symbol = _hashes(new), self.by_ending[_endings(new)]
        if len(self.head):
            at = np.minimum(np.searchsorted(self.head, h), len(self.head) - 1)
            symbol = np.where(self.head[at] == h, self.rank[at], symbol)
        log_c, here = self.lexicon.log_c(h)
        put = slice(first, len(self))
        self.h[put], self.symbol[put], self.log_c[put], self.here[put] = h, symbol, np.where(here, log_c, 0.0), here

    def of(self, every: list[bytes]) -> np.ndarray:
        """Places of tokens; forgets all others where the new ones don't fit."""
        at = np.fromiter(map(self.get, every, repeat(-1)), np.int64, len(every))
        missing = np.flatnonzero(at < 0)
        if not len(missing):
            return at
        new = list(dict.fromkeys([every[k] for k in missing.tolist()]))
        if len(self) + len(new) > len(self.h):
            new, missing = list(dict.fromkeys(every)), np.arange(len(every))
            self._make(max(len(self.h), len(new)))
        self._put(new)
        at[missing] = np.fromiter((self[every[k]] for k in missing.tolist()), np.int64, len(missing))
        return at


# The model


def features(symbol: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Rows of the class weights that each token's history selects; ``nth`` is its number in its text."""
    last = []
    for back in (1, 2, 3):
        x = np.full(len(symbol), _NONE, np.int64)
        x[back:] = symbol[:-back]
        x[nth < back] = _NONE
        last.append(x)
    pair = (last[0] * 1_000_003 + last[1] * 7919) % HASHED
    return np.column_stack([1 + k * _SYMBOLS + x for k, x in enumerate(last)] + [1 + 3 * _SYMBOLS + pair])


def _class(symbol: np.ndarray) -> np.ndarray:
    return np.where(symbol < HEAD, symbol // WIDE, symbol - HEAD + HEAD // WIDE)


def start_weights(lexicon: Lexicon) -> np.ndarray:
    """The model without history: shares of classes, and of tokens in their classes."""
    w1, w2 = np.zeros((_ROWS1, _CLASSES), np.float32), np.zeros((_ROWS2, HEAD), np.float32)
    by_class = np.concatenate((lexicon.head_counts.reshape(-1, WIDE).sum(axis=1), lexicon.tail_n))
    w1[0] = np.log(by_class + SMOOTH)
    w2[0] = np.log(lexicon.head_counts + SMOOTH)
    return np.concatenate((w1.reshape(-1), w2.reshape(-1)))


def _views(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return weights[:_SIZE1].reshape(_ROWS1, _CLASSES), weights[_SIZE1:].reshape(_ROWS2 * (HEAD // WIDE), WIDE)


def _total(table: np.ndarray, at: list[np.ndarray]) -> np.ndarray:
    """Sums of rows of a table."""
    x = table.take(at[0], axis=0)
    other = np.empty_like(x)
    for k in at[1:]:
        x += table.take(k, axis=0, out=other, mode="clip")
    return x


def _normalized(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores, their exponentials and the sums of those, rows lowered by their largest score where need be."""
    if x.size and max(x.max(), -x.min()) > FAR:
        x -= x.max(axis=1, keepdims=True)
    e = np.exp(x)
    return x, e, e @ np.ones(x.shape[1], x.dtype)


def _steps(weights: np.ndarray, rows: np.ndarray, symbol: np.ndarray):
    """Scores of classes and of tokens in classes (see ``_normalized``), with what they were made of."""
    w1, w2 = _views(weights)
    chosen = [np.ascontiguousarray(rows[:, k]) for k in range(rows.shape[1])]
    classes = _total(w1, chosen)
    classes += w1[0]
    head = np.flatnonzero(symbol < HEAD)
    group = symbol[head] // WIDE
    within = [group, *(k[head] * (HEAD // WIDE) + group for k in chosen)]
    return _normalized(classes), head, chosen, within, _normalized(_total(w2, within))


def _gradient(e: np.ndarray, total: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """What came less what was expected, in place of the exponentials."""
    e *= (np.float32(-1) / total)[:, None]
    e[np.arange(len(e)), chosen] += 1
    return e


def _add(table: np.ndarray, past: np.ndarray, at: np.ndarray, gradient: np.ndarray, rate: float) -> None:
    """An adaptive gradient step for the rows ``at``, which may repeat."""
    # Numbers of 16 bits are sorted by digits, several times as fast.
    order = np.argsort(at.astype(np.uint16) if len(table) <= 1 << 16 else at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    row = at[first]
    if gradient.shape[1] > WIDE:
        total = _summed(gradient, order, first)
    else:
        total = np.add.reduceat(gradient.take(order, axis=0), first, axis=0)
    before = past.take(row, axis=0)
    before += total * total
    past[row] = before
    total *= rate
    total /= np.sqrt(before, out=before)
    table[row] += total


def _summed(gradient: np.ndarray, order: np.ndarray, first: np.ndarray, few: int = 12) -> np.ndarray:
    """Sums of rows of each run of ``order``: short runs all at once, row by row, each long one by a product."""
    size = np.diff(first, append=len(order))
    total = gradient.take(order[first], axis=0)
    short, ones = np.flatnonzero((size > 1) & (size <= few)), np.ones(size.max(), gradient.dtype)
    for k in range(1, few):
        short = short[size[short] > k]
        total[short] += gradient.take(order[first[short] + k], axis=0)
    long = size > few
    rows = gradient.take(order[np.repeat(long, size)], axis=0)
    at = 0
    for k, n in zip(np.flatnonzero(long).tolist(), size[long].tolist(), strict=True):
        np.dot(ones[:n], rows[at : at + n], out=total[k])
        at += n
    return total


def learn(weights: np.ndarray, past: np.ndarray, rows: np.ndarray, symbol: np.ndarray, rate: float) -> None:
    """One gradient step over a batch of tokens, in place."""
    (_, classes, all_classes), head, chosen, within, (_, inner, all_inner) = _steps(weights, rows, symbol)
    w1, w2 = _views(weights)
    p1, p2 = _views(past)
    g = _gradient(classes, all_classes, _class(symbol))
    for at in chosen:
        _add(w1, p1, at, g, rate)
    total = g.sum(axis=0)
    p1[0] += total * total
    w1[0] += rate * total / np.sqrt(p1[0])
    if len(head):
        g = _gradient(inner, all_inner, symbol[head] % WIDE)
        for at in within:
            _add(w2, p2, at, g, rate)


def log_probabilities(weights: np.ndarray, rows: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """log10 of each token's class, and for tokens of the head of the token itself."""
    (classes, _, all_classes), head, _, _, (inner, _, all_inner) = _steps(weights, rows, symbol)
    out = (classes[np.arange(len(classes)), _class(symbol)] - np.log(all_classes)).astype(np.float64)
    out[head] += inner[np.arange(len(head)), symbol[head] % WIDE] - np.log(all_inner)
    return out / np.log(10)


def _numbered(texts: list[list[bytes]]) -> np.ndarray:
    counts = np.array([len(t) for t in texts], np.int64)
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _trained(sent, rate: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    start, lexicon = sent.value
    weights, past = start.copy(), np.ones_like(start)
    symbols, seen = Symbols(lexicon), 0
    for batch in slices(batches, 64):
        texts = [tokens(t) for t in batch.column(0).to_pylist()]
        at = symbols.of([t for text in texts for t in text])  # may make new arrays
        symbol = symbols.symbol[at]
        rows = features(symbol, _numbered(texts))
        for at in range(0, len(symbol), BATCH):
            learn(weights, past, rows[at : at + BATCH], symbol[at : at + BATCH], rate)
        seen += len(symbol)
    if seen:
        # Changes rather than weights: small numbers, in half precision, a third of the shuffle.
        parts = np.array_split((weights - start).astype(np.float16), _BLOCKS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(_BLOCKS), pa.int32()), pa.array([seen] * _BLOCKS, pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())],
            ["block", "tokens", "change"],
        )


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of changes, weighted by tokens, one partition after the other."""
    sums: dict[int, np.ndarray] = {}
    seen: Counter = Counter()
    for batch in slices(batches, 16):
        for block, n, change in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            part = np.frombuffer(change, np.float16).astype(np.float64) * n
            sums[block] = sums[block] + part if block in sums else part
            seen[block] += n
    names = sorted(sums)
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.int32()), pa.array([seen[b] for b in names], pa.int64()), pa.array([(sums[b] / seen[b]).astype(np.float32).tobytes() for b in names], pa.binary())],
        ["block", "tokens", "change"],
    )


def fit(train: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS) -> np.ndarray:
    """Weights after one pass over ``train`` (``text``, ``part``: the round that a text is for)."""
    spark = train.sparkSession
    weights = start_weights(lexicon)
    schema = "block int, tokens bigint, change binary"
    for k in range(rounds):
        sent = spark.sparkContext.broadcast((weights, lexicon))
        changes = train.where(F.col("part") == k).select("text").mapInArrow(partial(_trained, sent, RATES[min(k, len(RATES) - 1)]), schema)
        rows = changes.repartition(_BLOCKS, "block").mapInArrow(_averaged, schema).collect()
        for row in rows:
            at = int(row["block"])
            size, extra = divmod(len(weights), _BLOCKS)
            first = at * size + min(at, extra)
            part = np.frombuffer(row["change"], np.float32)
            weights[first : first + len(part)] += part
        sent.unpersist()
    return weights


# Scoring


def _scored(sent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    weights, lexicon = sent.value
    symbols, uid = Symbols(lexicon), TaskContext.get().partitionId() << 40
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in slices(batches, 64):
        texts = [tokens(t) for t in batch.column(1).to_pylist()]
        counts = np.array([len(t) for t in texts], np.int64)
        at = symbols.of([t for text in texts for t in text])
        h, symbol, log_c, here = symbols.h[at], symbols.symbol[at], symbols.log_c[at], symbols.here[at]
        rows = features(symbol, _numbered(texts))
        score = np.concatenate([log_probabilities(weights, rows[at : at + CACHED], symbol[at : at + CACHED]) for at in range(0, len(symbol), CACHED)])
        tail = symbol >= HEAD
        score[tail] += log_c[tail] - lexicon.share[symbol[tail] - HEAD]
        first = np.cumsum(counts) - counts
        parts = zip(np.split(h, first[1:]), np.split(~here, first[1:]), strict=True)
        rest = [np.unique(x[y], return_counts=True) if y.any() else none for x, y in parts]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(uid, uid + len(texts))),
                batch.column(0),
                pa.array(counts),
                pa.array(np.add.reduceat(here.astype(np.int64), first)),
                pa.array(np.add.reduceat(log_c, first)),
                pa.array(np.add.reduceat(score, first)),
                pa.array([x for x, _ in rest], pa.list_(pa.int64())),
                pa.array([n for _, n in rest], pa.list_(pa.int64())),
            ],
            ["uid", "doc_id", "n_tokens", "known", "logs", "score", "rest", "times"],
        )
        uid += len(texts)


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document row: ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    The model learns from rows outside the held-out fold. A null or empty text is its end alone.
    Without training rows all tokens are unknown, and both models are even.
    """
    spark = docs.sparkSession
    source = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].cast("string").alias("text"))
    train = source.where(remainder(F.col("doc_id"), FOLDS) != 0)
    counts = token_counts(train.select("text"))
    lexicon = Lexicon(counts)
    part = F.pmod(F.xxhash64("doc_id", F.lit("round")), F.lit(ROUNDS))
    weights = fit(train.select("text", part.alias("part")), lexicon)
    sent = spark.sparkContext.broadcast((weights, lexicon))
    schema = "uid bigint, doc_id bigint, n_tokens bigint, known bigint, logs double, score double, rest array<bigint>, times array<bigint>"
    scored = staged(source.mapInArrow(partial(_scored, sent), schema), "scored")
    rare = scored.select("uid", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("uid", F.col("x.rest").alias("h"), "x.times")
    found = (
        rare.join(counts.select("h", "c"), "h", "left")
        .groupBy("uid")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + SMOOTH)).alias("more_logs"),
        )
    )
    none = np.log10(lexicon.n + SMOOTH * (lexicon.v + 1))
    more = F.coalesce("more_logs", F.lit(0.0))
    return scored.join(found, "uid", "left").select(
        "doc_id",
        (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(int(lexicon.n)).cast("bigint").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * float(none)).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
