"""Vector links, lexical search and the manifest: against brute force, on edge rows, and what their methods rest on."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from haulmetry.llm import hnsw, lexical, merkle, tokenfile

#: Names that the operators use inside; the input may have them too.
CLASHES = "g lo n digest _key _row _part block level own steps uid v key copies least dim shard root item term terms counts rank score _g _p _c".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in CLASHES)


def test_all_are_registered():
    assert [sum(n.startswith(f"op{k}_") for n in entry.queries()) for k in (11, 12, 13)] == [1] * 3


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(40)] + ["Ä", "日本", "x1"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    made = [
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, "...\n !", None, None, 6),
        (None, text(30), "en", "b", 9),
        (None, text(30), None, "b", 9),
        (4, text(20_000), "en", "b", 9),
        (5, text(25), "en", "b", 2**63 - 1),
        (6, text(25), "de", "b", 9),
        (6, text(25), "de", "c", 9),
        *[(7, "w1 w2 W3", "fr", "c", 8)] * 3,
        *[(k, text(40), "en", "c", None if k % 5 else k) for k in range(20, 180)],
    ]
    return [(*r, *["x"] * len(CLASHES)) for r in made]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


# Manifest


def _digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def _part(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_digest(*levels[-1][k : k + arity]) for k in range(0, len(levels[-1]), arity)])
    return levels


def _path(levels, k, arity):
    out = []
    for nodes in levels[:-1]:
        first = k // arity * arity
        out.append(("".join(nodes[first:k]), "".join(nodes[k + 1 : first + arity])))
        k //= arity
    return out


def _manifest(rows, arity=2):
    groups = {}
    for r in rows:
        leaf = _digest(*(_part(r[k]) for k in (0, 3, 2, 4, 1)))
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf, r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees[name] = _tree([leaf for _, _, leaf, _ in groups[name]], arity)
    trunk = _tree([trees[name][-1][0] for name in names], arity)
    out = []
    for nth, name in enumerate(names):
        for k, (_, _, leaf, r) in enumerate(groups[name]):
            steps = _path(trees[name], k, arity) + _path(trunk, nth, arity)
            own = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                own = _digest(*(_part(v) for v in (r[0], r[3], r[2], r[4] + 1, r[1])))
            for left, right in steps:
                own = _digest(left, own, right)
            proof = _digest(*(left + right for left, right in steps))
            out.append((r[0], leaf, trees[name][-1][0], trunk[-1][0], proof, own, own == trunk[-1][0]))
    return out


def _sorted(found):
    return sorted(map(repr, map(tuple, found)))


def test_manifest_of_messy_rows(docs, rows):
    got = merkle.verified(docs)
    assert _sorted(got.collect()) == _sorted(_manifest(rows))
    assert merkle.verified(docs.limit(0)).count() == 0
    assert not all(r.verified for r in got.collect()) and sum(r.verified for r in got.collect()) > 100


@pytest.mark.parametrize(("arity", "depth", "n"), [(2, 1, 9), (3, 2, 1), (3, 2, 30), (5, 1, 27), (2, 6, 64), (2, 6, 65)])
def test_any_shape_of_tree(spark, arity, depth, n):
    made = [(k, f"t{k}", ("x", None, "y")[k % 3] if n > 40 else "x", "s", k) for k in range(n)]
    frame = spark.createDataFrame(made, SCHEMA.split(", g ")[0])
    got = merkle.manifest(frame, arity=arity, depth=depth)
    shown = got.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")), merkle.folded(F.col("leaf"), F.col("steps")))
    assert _sorted(shown.collect()) == _sorted([(*r[:5], r[3]) for r in _manifest(made, arity)])


def test_nodes_cover_their_intervals(spark):
    leaves = spark.range(100).select(F.lit("a").alias("g"), F.col("id").alias("lo"), F.lit(100).cast("bigint").alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    nodes = [r for part in merkle.grown(leaves, 2, 3) for r in part.collect()]
    for level in range(8):
        spans = sorted({(r.lo, r.hi) for r in nodes if r.level == level})
        assert spans[0][0] == 0 and spans[-1][1] == 100
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False)) and all(b - a <= 2**level for a, b in spans)


# Search


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _search(docs, items, best=10):
    counted = [(i, Counter(_terms(t))) for i, t in docs]
    n, total = sum(bool(c) for _, c in counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(_terms(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc, c in counted:
            if c:
                m = 10 + 90 * c.total() * n // total
                score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms & c.keys())
                if score > 0:
                    scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, doc, -score) for k, (score, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:best])]
    return out


ITEMS = [(1, "W1 w2, w3"), (1, "w4"), (2, None), (3, ""), (None, "x1 ä Ä"), (4, "日本 w5 w5"), (5, "nowhere"), (6, "w6"), (6, "w6")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*i, "x", "x") for i in ITEMS], "item_id bigint, text string, doc_id string, score string")


def test_search_of_messy_rows(docs, rows, items):
    want = _search([r[:2] for r in rows], ITEMS)
    assert _sorted(lexical.ranked(docs, items).collect()) == _sorted(want)
    assert _sorted(lexical.ranked(docs, items, best=3).collect()) == _sorted([r for r in want if r[1] <= 3])
    assert lexical.ranked(docs.limit(0), items).count() == lexical.ranked(docs, items.limit(0)).count() == 0


def test_blocks_of_items_change_nothing(docs, rows, items, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_TEXT", 12)
    monkeypatch.setattr(lexical, "_HELD", 10)
    assert _sorted(lexical.ranked(docs, items).collect()) == _sorted(_search([r[:2] for r in rows], ITEMS))


def test_equal_scores_go_by_id(spark):
    made = [(k, "alpha beta") for k in (9, 3, None, 7, 3, 12)] + [(k, f"other{k}") for k in range(100, 130)]
    got = lexical.ranked(spark.createDataFrame(made, "doc_id bigint, text string").repartition(5), spark.createDataFrame([(1, "alpha")], "item_id bigint, text string")).orderBy("rank").collect()
    assert [r.doc_id for r in got] == [3, 3, 7, 9, 12, None] and len({r.score for r in got}) == 1


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAbzZ09 .-_éÉ日  \x00\x7f", max_size=60), st.lists(st.text(alphabet="abz09éÉ日 ", min_size=1, max_size=3), max_size=6, unique=True))
def test_automaton_counts_terms(text, terms):
    total, found, times = lexical.Automaton(terms).counts(text.encode())
    want = Counter(_terms(text))
    assert total == want.total()
    assert {terms[k]: n for k, n in zip(found.tolist(), times.tolist(), strict=True)} == {t: want[t] for t in terms if t in want}


# Vectors


def _links(vectors):
    """Rows by comparing all pairs."""
    sound = [k for k, (_, v) in enumerate(vectors) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    near = {k: [] for k in range(len(vectors))}
    for dim in {len(vectors[k][1]) for k in sound}:
        some = [k for k in sound if len(vectors[k][1]) == dim]
        v = np.array([vectors[k][1] for k in some], np.float64)
        v /= np.abs(v).max(axis=1, keepdims=True)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(v @ v.T >= 0.9), strict=True):
            if a != b:
                near[some[a]].append(some[b])
    out, seen = [None] * len(vectors), set()
    for k in near:
        if k in seen:
            continue
        group, todo = {k}, [k]
        while todo:
            todo += (new := set(near[todo.pop()]) - group)
            group |= new
        seen |= group
        ids = [vectors[j][0] for j in group if vectors[j][0] is not None]
        least = min(ids, default=None)
        for j in group:
            out[j] = (vectors[j][0], len(near[j]), least, vectors[j][0] == least)
    return out


def _turned(rng, v, cosine):
    side = rng.standard_normal(len(v))
    side -= side @ v / (v @ v) * v
    return cosine * v / np.linalg.norm(v) + math.sqrt(1 - cosine**2) * side / np.linalg.norm(side)


@pytest.fixture(scope="module")
def crowd():
    """Noise, pairs about the limit, a chain, copies, and a crowd of near copies that is a third of all."""
    rng = np.random.default_rng(7)
    made = [rng.standard_normal(24) for _ in range(600)]
    made += [_turned(rng, v, c) for v, c in zip(made[:60], np.linspace(0.86, 0.99, 60), strict=True)]
    chain = [rng.standard_normal(24)]
    for _ in range(40):
        chain.append(_turned(rng, chain[-1], 0.93))
    centre = rng.standard_normal(24)
    made += chain + [made[0]] * 20 + [_turned(rng, centre, c) for c in rng.uniform(0.9, 1, 400)]
    ids = rng.permutation(len(made)).tolist()
    return [(i, v.tolist()) for i, v in zip(ids, made, strict=True)]


@pytest.mark.parametrize(("shards", "shard_numbers"), [(1, 10**6), (3, 24 * 150)])
def test_links_of_a_crowd(spark, crowd, shards, shard_numbers):
    frame = spark.createDataFrame([(*r, "x") for r in crowd], "vec_id bigint, embedding array<double>, uid string")
    assert _sorted(hnsw.near_vectors(frame, shards=shards, shard_numbers=shard_numbers).collect()) == _sorted(_links(crowd))


def test_links_of_messy_rows(spark):
    nan, inf = float("nan"), float("inf")
    made = [
        *[(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, -0.0])],
        *[(8, [1.0, 0.0]), (9, [1e300, 1e299]), (10, [1e-300, 0.0]), (11, [1.0, 0.0, 0.0]), (12, [1.0]), (13, [-1.0, 0.0])],
        *[(14, [2.0]), (14, [2.0]), (14, [-2.0]), (None, [0.0, 1.0]), (None, [0.0, 2.0]), (None, [-5.0, 0.1]), (None, None)],
    ]
    frame = spark.createDataFrame([(*r, "x", "x") for r in made], "vec_id bigint, embedding array<double>, key string, v string")
    assert _sorted(hnsw.near_vectors(frame).collect()) == _sorted(_links(made))
    assert hnsw.near_vectors(frame.limit(0)).count() == 0
    assert hnsw.near_vectors(frame.where("vec_id = 1")).collect() == [(1, 0, 1, True)]


def test_walk_finds_what_it_audits():
    rng = np.random.default_rng(1)
    vectors = hnsw._unit(rng.standard_normal((3000, 48)))
    graph = hnsw.Graph(vectors, np.arange(3000))
    graph.audit()
    assert graph.recall >= hnsw.AUDIT_SHARE and graph.beam < 3000 and len(graph.centres) == 3000
    turned = np.array([_turned(rng, v, 0.9 + 1e-9) for v in vectors[:500]])
    found = graph.linked(turned, np.ones(3000, np.int64), False)[0]
    assert found.sum() >= 0.98 * (turned @ vectors.T >= 0.9).sum()


def test_audit_widens_a_beam_that_misses():
    rng = np.random.default_rng(2)
    graph = hnsw.Graph(hnsw._unit(rng.standard_normal((1500, 48))), np.arange(1500))
    graph.links[0][:, 2:] = -1  # a poor graph: most links are gone
    graph.beam = 1
    graph.audit()
    assert graph.beam > 16 and graph.recall >= hnsw.AUDIT_SHARE


# Token files: boundaries by ranges, and words cut as ASCII


def test_spans_of_boundaries_are_those_of_select():
    rng = random.Random(5)
    for n in (1, 2, 255, 257, 3000):
        for most in (1, 3, 700, 10**6):
            ends = np.cumsum([0, *(rng.randrange(most) + 1 for _ in range(n - 1))])
            low, lows, high, samples = tokenfile.encode_boundaries(ends)
            held = tokenfile.Boundaries(n, low, lows + high + samples)
            for _ in range(20):
                a = rng.randrange(n)
                b = rng.randint(a, n)
                assert held.span(a, b).tolist() == ends[a:b].tolist() == [held[k] for k in range(a, b)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aZ09 \t\n.,'s<|>_-\x00\x1c\x7f\xa0é²ªǅ日 ", max_size=30))
def test_words_are_encoded_as_in_their_text(text):
    whole = tokenizers.Tokenizer.from_file(public_tokenizers.path(tokenfile.VOCABULARY))
    made = tokenfile.encoder(public_tokenizers.path(tokenfile.VOCABULARY), 2)
    assert np.frombuffer(made.encode([text])[0], "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids
