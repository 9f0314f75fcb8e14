"""What operators must not do twice, or to rows that don't need it."""

import random

import numpy as np
import pyarrow as pa

from haulmetry.llm import maxent, minhash
from haulmetry.llm.common import settings, ship


class Counted:
    """Counts of tokens that note how many are looked up."""

    head = np.array([maxent._hash(t) for t in (b"the", b"of")], np.int64)
    tail_of = {maxent._ending(b"a"): 3, maxent._ending(b"xyz"): 5}
    asked = 0

    def log_c(self, h):
        self.asked += len(h)
        return np.arange(len(h)) + 1.0, h % 2 == 0


def test_language_model_looks_a_token_up_once():
    made = [b"the", b"a", b"xyz", b"of", b"q\x00", maxent.END]
    lexicon = Counted()
    symbols = maxent.Symbols(lexicon)
    first, again = symbols.of(made * 50), symbols.of(made[::-1])
    assert lexicon.asked == len(made) and (first.reshape(50, -1) == again[::-1]).all()
    assert symbols.h[again[::-1]].tolist() == [maxent._hash(t) for t in made]
    tail = maxent.HEAD + maxent.TAIL - 1
    assert symbols.symbol[again[::-1]].tolist() == [0, maxent.HEAD + 3, maxent.HEAD + 5, 1, tail, tail]


def test_language_model_forgets_tokens_that_do_not_fit():
    symbols, rng = maxent.Symbols(Counted(), most=5), random.Random(3)
    for size in (2, 4, 30, 3):
        tokens = [b"t%d" % rng.randrange(40) for _ in range(size)]
        at = symbols.of(tokens)
        assert symbols.h[at].tolist() == [maxent._hash(t) for t in tokens]


def test_language_model_learns_the_same_when_tokens_are_forgotten(monkeypatch):
    class Lexicon(Counted):
        head, tail_of = Counted.head, Counted.tail_of

    class Sent:
        value = np.zeros(maxent._SIZE1 + maxent._SIZE2, np.float32), Lexicon()

    texts = [" ".join(rng.choice(["the", "of", "a", "xyz", f"w{rng.randrange(500)}"]) for _ in range(40)) for rng in map(random.Random, range(200))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])

    def learnt():
        return [c.as_py() for c in next(maxent._trained(Sent, 0.5, iter([batch]))).column("change")]

    whole, make = learnt(), maxent.Symbols.__init__
    monkeypatch.setattr(maxent.Symbols, "__init__", lambda self, lexicon: make(self, lexicon, most=300))
    assert learnt() == whole


def test_gradient_rows_are_summed_by_run():
    rng = np.random.default_rng(5)
    at = np.minimum(rng.zipf(1.4, 3000), 200)
    gradient = rng.normal(size=(3000, 64)).astype(np.float32)
    order = np.argsort(at, kind="stable")
    first = np.flatnonzero(np.diff(at[order], prepend=-1))
    summed = maxent._summed(gradient, order, first)
    assert np.allclose(summed, [gradient[at == k].sum(axis=0) for k in np.unique(at)], atol=1e-3)


def test_most_documents_stay_where_they_are(spark):
    """Only documents that may be left out meet the rows to leave out, too many to be broadcast here."""
    ship(spark)
    rng = random.Random(7)
    texts = [" ".join(str(rng.randrange(10**6)) for _ in range(30)) for _ in range(300)]
    made = [(k, t) for k, t in enumerate(texts)] + [(1000 + k, t) for k, t in enumerate(texts[:20])] + [(5, texts[5])] * 3
    docs = spark.createDataFrame(made, "doc_id bigint, text string")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        kept = minhash.one_of_each(docs)
        plan = kept._jdf.queryExecution().optimizedPlan()
        branches = [plan.children().apply(k).toString() for k in range(plan.children().size())]
        assert sum("Join" not in branch for branch in branches) == 1
        assert sorted(tuple(r) for r in kept.collect()) == sorted(enumerate(texts))


def test_the_filter_finds_all_and_few_others(spark):
    named = spark.range(21_000).selectExpr("id", "unhex(md5(cast(id as string))) as row")
    listed = minhash._may_hold(named.where("id < 1000").select("row"))
    found = {r.id for r in named.where(listed).collect()}
    assert found >= set(range(1000)) and len(found) < 1000 + 0.03 * 20_000
