"""The registered queries against SQL and brute force, and what the methods rest on."""

import base64
import hashlib
import io
import math
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from conftest import DATA

import __spark_entry__ as entry
import corpus_pipeline
from haulmetry.llm import archive, decontam, linedup, maxent, minhash, oracle, quality, secrets, tokenfile, toxicity

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

QUERIES = {n: f for n, f in entry.queries().items() if re.match(r"op\d+_|pipeline", n)}


@pytest.fixture(scope="module")
def docs(duck):
    return duck.sql("select doc_id, text from documents order by doc_id").fetchall()


def test_all_are_registered():
    assert [sum(n.startswith(f"op{k}_") for n in QUERIES) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in QUERIES and 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_matches_sql(spark, duck, name):
    got, want = QUERIES[name](spark, DATA).toArrow(), duck.sql(oracle.SQL[name]).to_arrow_table()
    columns = sorted(got.column_names)
    rounded = lambda t: sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r.values()]) for r in t.select(columns).to_pylist())
    assert columns == sorted(want.column_names) and rounded(got) == rounded(want)


def test_mix_meets_its_targets(spark, duck):
    run = lambda: QUERIES["op6_mixing"](spark, DATA).toPandas().sort_values("doc_id", ignore_index=True)
    rows, source = run(), dict(duck.sql("select doc_id, source from documents").fetchall())
    assert (rows.taken <= 2 * rows["size"]).all()
    by = rows.groupby(rows.doc_id.map(source)).agg({"taken": "sum", "size": "max", "target": "first"})
    assert (abs(by.taken - by.target) <= by["size"]).all()
    assert rows.equals(run())


# Near-duplicates


def test_probability_jaccard():
    rng = random.Random(1)
    for _ in range(30):
        x, y = ({rng.randrange(40): rng.random() + 0.1 for _ in range(25)} for _ in "xy")
        arrays = [f(d) for d in (x, y) for f in (lambda d: np.array(sorted(d), np.uint64), lambda d: np.array([d[k] for k in sorted(d)]))]
        assert minhash.probability_jaccard(*arrays) == pytest.approx(brute.probability_jaccard(x, y))


def test_signatures_estimate_it():
    rng = np.random.default_rng(2)
    for n in (1, 3, 40, 3000):
        a, w = np.sort(rng.integers(0, 2**63, n).astype(np.uint64)), rng.random(n) + 0.5
        b = np.sort(np.concatenate((a[n // 10 :], rng.integers(0, 2**63, n // 10).astype(np.uint64))))
        v = np.where(np.isin(b, a), w[np.minimum(np.searchsorted(a, b), n - 1)], 1.0)
        one, two = minhash.signatures([a, b], [w, v])
        assert (one == two).mean() == pytest.approx(minhash.probability_jaccard(a, w, b, v), abs=0.13)
        assert (minhash.signatures([a], [w])[0] == one).all()


def test_near_duplicate_classes(spark, docs):
    got = {r.doc_id: r.class_id for r in QUERIES["op8_near_duplicates"](spark, DATA).collect()}
    assert got == brute.classes(docs)


def test_chains_and_hot_groups(spark):
    """Copies of a hundred texts that each differ from the next: one class, and what is apart stays apart."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = []
    for k in range(60):
        rows.append((k, " ".join(words)))
        words[(7 * k) % 300 : (7 * k) % 300 + 3] = [f"x{k}a", f"x{k}b", f"x{k}c"]
    rows += [(100 + k, " ".join(f"y{k}z{j}" for j in range(50))) for k in range(20)]
    rows += [(1000 + k, rows[0][1]) for k in range(300)]
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {got[k] for k in range(60)} == {0} and {got[1000 + k] for k in range(300)} == {0}
    assert all(got[100 + k] == 100 + k for k in range(20))


def test_band_dealt_to_groups(spark, monkeypatch):
    """A band that is open in the last round gives the same classes however finely it is dealt."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(60):  # a family: many pairs near 0.8 on both sides
        words = list(base)
        for at in rng.sample(range(120), 3):
            words[at] = f"x{rng.randrange(40)}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(minhash, "ROUNDS", 0)
    whole = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    monkeypatch.setattr(minhash, "TOGETHER", 7)
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()} == whole == brute.classes(rows)


# Decontamination


def test_leaks(spark, duck, docs):
    items = duck.sql("select item_id, text from benchmark").fetchall()
    got = {(r.doc_id, r.item_id) for r in QUERIES["op4_decontamination"](spark, DATA).collect()}
    assert got and got == brute.leaks(docs, items)


def test_edited_passages():
    rng = random.Random(4)
    items = [(k, " ".join(f"i{k}w{rng.randrange(99)}" for _ in range(rng.randint(30, 59)))) for k in range(40)]
    texts = []
    for k, text in items:
        words = text.split()
        words[-1 if k % 2 else 0] = "changed"
        texts.append((k, " ".join([*(f"a{j}" for j in range(k)), *words, "tail"])))
    held = decontam.Items(items)
    assert {(k, i) for k, t in texts for i in decontam.matches(t, held)} == brute.leaks(texts, items)


def test_multi_index_misses_nothing_within_the_radius():
    rng = np.random.default_rng(6)
    held = decontam.Items([(k, " ".join(f"{k}x{j}" for j in range(20))) for k in range(30)])
    windows = held.prints.repeat(20, axis=0)
    for row in windows:
        for bit in rng.choice(64, rng.integers(0, 40), replace=False):
            row[bit // 8] ^= 1 << (bit % 8)
    apart = np.unpackbits(windows[:, None] ^ held.prints[None], axis=2).sum(axis=2)
    every = (x.ravel() for x in np.indices(apart.shape))
    assert set(zip(*(x.tolist() for x in held.candidates(20, windows, *every)), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(apart <= decontam.RADIUS)), strict=True))


def test_documents_shorter_than_an_item():
    words = [f"w{k}" for k in range(40)]
    texts = [(k, " ".join(words[a:b])) for k, (a, b) in enumerate([(0, 39), (1, 40), (0, 35), (3, 36), (0, 32), (0, 4), (0, 40), (2, 38)])]
    items = [(1, " ".join(words)), (2, "w0 w1 w2 w3"), (3, "w1 w2")]
    held = decontam.Items(items)
    got = {(k, i) for k, t in texts for i in decontam.matches(t, held)}
    assert {p for p in got if p[1] == 1} == brute.leaks(texts, items[:1]) >= {(0, 1), (1, 1), (6, 1)} and (4, 1) not in got
    assert (5, 2) in got and (0, 3) in got


def test_postings_choose_few_pairs():
    """Of all pairs of a window and an item of its size, few are looked up."""
    rng = random.Random(8)
    common = [f"c{k}" for k in range(60)]
    items = [(k, " ".join([*(rng.choice(common) for _ in range(6)), *(f"i{k}x{j}" for j in range(24))])) for k in range(200)]
    held = decontam.Items(items)
    looked, plain = [], held.candidates
    held.candidates = lambda n, windows, w, i: (looked.append((len(windows), len(w))), plain(n, windows, w, i))[1]
    for k, text in items[:40]:
        body = " ".join([*(rng.choice(common) for _ in range(200)), text, *(rng.choice(common) for _ in range(200))])
        assert k in decontam.matches(body, held)
    assert sum(p for _, p in looked) < 0.05 * 200 * sum(w for w, _ in looked)


# Token files


def test_token_rows(spark, docs):
    got = sorted(tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in QUERIES["op5_tokens"](spark, DATA).collect())
    assert got == brute.token_rows(docs)


@pytest.mark.parametrize("text", ["", "  a   b \n\n c", "x\x1c y　z", "<|endoftext|> a", "it's 'll 12½ ²", "é́ 日本 語​", "\r\n\t "])
def test_pieces_are_encoded_as_in_their_text(text):
    import public_tokenizers

    encoder = tokenfile.Encoder(public_tokenizers.path(tokenfile.VOCABULARY), 2)
    assert np.frombuffer(encoder.encode([text])[0], "<u2").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_boundaries():
    rng = np.random.default_rng(1)
    for bounds in ([0], [0, 1], [0, 10**7], np.arange(3000), np.repeat([0, 5, 9, 4000], 700), np.cumsum(rng.integers(0, 900, 5000)) * (np.arange(5000) > 0)):
        bounds = np.sort(np.array(bounds, np.int64))
        low, *parts = tokenfile.encode_boundaries(bounds)
        read = tokenfile.Boundaries(len(bounds), low, b"".join(parts))
        assert (read.all() == bounds).all() and [read[k] for k in range(len(bounds))] == bounds.tolist()
    assert 8 * len(b"".join(parts)) / len(bounds) < 13


def test_random_access(spark, docs):
    manifest = tokenfile.write_tokens(spark.read.parquet(f"{DATA}/documents.parquet")).collect()
    want = {r[0]: r for r in brute.token_rows(docs)}
    for row in manifest:
        fs, path = tokenfile.file_system(row["path"])
        with fs.open_input_file(path) as file:
            shard = tokenfile.Shard(file)
            for k in random.Random(1).sample(range(row["documents"]), min(20, row["documents"])):
                assert zlib.crc32(shard.document(k)) == want[row["doc_ids"][k]][3]


# Secrets


def test_secret_base(spark, docs):
    texts = dict(docs)
    for r in QUERIES["op7_secrets"](spark, DATA).collect():
        listed, digest = brute.secret_spans(texts[r.doc_id])
        assert r.base_sha256 == digest
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(listed.count(f"{k}:") for k in ("assign", "access", "hex"))
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


@pytest.mark.parametrize(
    "text",
    ["secret=token: abcdefgh", "PassWord = 'abc' api_key: x.y-z_1234567", "AKIAAKIA" + "A1" * 9, "İtoken=abcdef12 ſecret=abcdef", "0123456789abcdef01234567 AKIA", "apikey\"='abcdef"],
)
def test_secret_patterns(text):
    base = secrets.base_spans(text, secrets.lowered(text))
    assert secrets.listed(base) == brute.secret_spans(text)[0]


def test_novel_strings():
    rng = random.Random(2)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPabcdefghijklmnop0123456789") for _ in range(32))
    novelty = secrets.Novelty(["configuration_value_2024", "example_identifier_1"])
    found = lambda t: [t[a:b] for a, _, b in novelty.spans(t, secrets.lowered(t))]
    assert found(f"the bearer credential is {key} here") == [key]
    assert found(f"a picture called {key} of a house") == []
    assert found("the session key is configuration_value_2024 again") == []
    assert found(f"auth {key} and again the auth {key}") == [key, key]


def _random(seed, n, letters="ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"):
    rng = random.Random(seed)
    return "".join(rng.choice(letters) for _ in range(n))


def _novel(text):
    spans = secrets.Novelty(["configuration_value", "example_identifier"]).spans(text, secrets.lowered(text))
    return [text[a:b] for a, _, b in spans]


def test_novel_values_of_assignments():
    key, part, letters = _random(1, 40), [_random(k, 70) for k in (2, 3, 4)], _random(5, 32, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
    for before in ("AWS_SECRET_ACCESS_KEY=", "export PRIVATE_KEY=", "https://a.example/b?auth=", "private_key: ", "auth.key."):
        assert _novel(f"{before}{key}\n") == [key]
        assert _novel(f"{before}{letters}\n") == [letters]
    assert _novel(f"PRIVATE_KEY={key[:38]}==\n") == [key[:38] + "=="]
    assert _novel(f"Authorization: Bearer {'.'.join(part)} ok") == part
    assert _novel(f"a picture=called.{key} of a house") == []


def test_novel_repeats():
    """A secret that is set and used near by is reported each time, wherever the copies are."""
    key, other = _random(6, 32), _random(7, 32)
    assert _novel(f"auth {key} and again the auth {key}") == [key, key]
    for gap in (1, 40, 230, 250, 260):
        assert _novel(f"SECRET_KEY={key}\n{'a b ' * (gap // 4)}\nlogin(secret='{key}', auth='{other}')") == [key, key, other]


def test_repeated_letters_are_no_identifiers(spark):
    key = _random(8, 32, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
    rows = [(1, f"auth = '{key}'\nuse_auth('{key}')"), (2, "use_auth(x)")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert secrets.frequent_identifiers(docs) == ["use_auth"]
    assert [r.spans.count("novel") for r in secrets.secrets(docs).orderBy("doc_id").collect()] == [2, 0]


# Archives


def test_warc_rows(spark, duck):
    pages = duck.sql("select page_id, html from pages").fetchall()
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in QUERIES["op9_warc"](spark, DATA).collect()}
    digest = {p: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for p, h in pages}
    keep = {}
    for p, d in digest.items():
        keep[d] = max(p, keep.get(d, p))
    want = {p: (len((h or "").encode()), digest[p], "response" if keep[digest[p]] == p else "revisit", None if keep[digest[p]] == p else keep[digest[p]]) for p, h in pages}
    assert got == want


def test_arc_versions():
    for version in (1, 2):
        name, content = "a.arc", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nhttp://x 1 2 text/html 3\nbody"
        plain = archive.arc_start(version, name) + archive.arc_record(version, "http://u/%20", content, 9, name)
        for data in (plain, archive._gzip(archive.arc_start(version, name)) + archive._gzip(archive.arc_record(version, "http://u/%20", content, 9, name))):
            [(_, fields, body)] = archive.arc_records(io.BytesIO(data))
            assert fields["URL"] == "http://u/%20" and body == content
    with pytest.raises(ValueError):
        list(archive.arc_records(io.BytesIO(plain[:-20])))


# Line dedup


def test_patience():
    assert linedup.patience(list("abcd"), list("abcd")) == [(k, k) for k in range(4)]
    assert linedup.patience(list("axbyc"), list("zabqc")) == [(0, 1), (2, 2), (4, 4)]
    assert linedup.patience(list("aaa"), list("aa")) == [(0, 0), (1, 1)]
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randrange(12) for _ in range(rng.randrange(15))] for _ in "ab")
        pairs = linedup.patience(a, b)
        assert all(a[x] == b[y] for x, y in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))


def test_removed_lines_stand_in_earlier_documents(spark, docs):
    seen, texts = {}, dict(docs)
    for doc, text in docs:
        for line in set(map(str.strip, text.split("\n"))):
            seen.setdefault(line, doc)
    rows = QUERIES["op3_line_dedup"](spark, DATA).collect()
    assert any(r.n_removed for r in rows)
    for r in rows:
        left, whole = Counter(r.text.split("\n") if r.n_removed < r.n_lines else []), Counter(texts[r.doc_id].split("\n"))
        assert not left - whole
        assert all(seen[line.strip()] < r.doc_id for line in whole - left if line.strip())


def test_shared_passages_are_removed(spark):
    rng = random.Random(8)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage = [line(30), "", line(30)]
    rows = [(k, "\n".join([line(20), *passage, line(20)])) for k in range(40)] + [(50, line(60))]
    got = {r.doc_id: r for r in linedup.line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[0].n_removed == got[50].n_removed == 0
    assert all(got[k].n_removed == 3 and got[k].partners == [0] and len(got[k].text.split("\n")) == 2 for k in range(1, 40))


def _left_behind(rows):
    """Places of lines with words in blocks of ten words or more that an earlier document holds, by all stretches of lines."""
    out, held = {}, set()
    for doc, text in sorted(rows):
        lines = [x.strip() for x in text.split("\n")]
        stretches = [(a, b) for a in range(len(lines)) for b in range(a + 1, len(lines) + 1) if len(" ".join(lines[a:b]).split()) >= linedup.MIN_WORDS]
        out[doc] = {k for a, b in stretches if tuple(lines[a:b]) in held for k in range(a, b) if lines[k]}
        held |= {tuple(lines[a:b]) for a, b in stretches}
    return out


def test_no_common_block_is_left(spark):
    """Short lines, each first held by some other document; blocks in another order, and twice in one."""
    rng = random.Random(11)
    short = [" ".join(f"s{k}w{j}" for j in range(1 + k % 5)) for k in range(40)]
    rows = [(k, line) for k, line in enumerate(short)]
    rows += [(100 + k, "\n".join(rng.choice(["", *short[:12]]) for _ in range(rng.randint(3, 14)))) for k in range(120)]
    block, other = short[20:26], short[30:36]
    rows += [(300, "\n".join(["a", *block, "b", *other])), (301, "\n".join([*other, "c", *block, "d", *other])), (302, "\n".join(["e", *block]))]
    want, texts = _left_behind(rows), dict(rows)
    got = {r.doc_id: r for r in linedup.line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[301].n_removed == 18 and got[302].text == "e"
    for doc, text in texts.items():
        lines = text.split("\n")
        left = Counter(filter(None, got[doc].text.split("\n")))
        assert left == Counter(x for k, x in enumerate(lines) if x and k not in want[doc])


# Language model


def test_base_scores(spark, docs):
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs}
    cut = lambda t: [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), None]
    c = Counter(w for d, t in docs if not held[d] for w in cut(t))
    n, v = sum(c.values()), len(c)
    rows = {r.doc_id: r for r in QUERIES["op2_language_model"](spark, DATA).collect()}
    for d, t in docs:
        words, r = cut(t), rows[d]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(words), sum(c[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(base)
    out = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_probabilities_sum_to_one():
    class Small:
        head_counts = np.arange(maxent.HEAD, 0, -1).astype(float)
        tail_n = np.arange(maxent.TAIL).astype(float)

    rng = np.random.default_rng(1)
    weights = maxent.start_weights(Small) + rng.normal(size=maxent._SIZE1 + maxent._SIZE2).astype(np.float32)
    history = rng.integers(0, maxent._SYMBOLS, 5)
    every = np.arange(maxent.HEAD + maxent.TAIL)
    rows = np.repeat(maxent.features(np.append(history, 0), np.arange(6))[-1:], len(every), axis=0)
    assert (10 ** maxent.log_probabilities(weights, rows, every)).sum() == pytest.approx(1, abs=1e-4)


def test_all_features_choose_in_classes():
    """A token of the head that only the pair before it, or only the third before it, tells apart is learnt."""

    class Small:
        head_counts = np.ones(maxent.HEAD)
        tail_n = np.ones(maxent.TAIL)

    rng = np.random.default_rng(2)
    for far in (False, True):
        x, y = rng.integers(0, 2, (2, 3000))
        symbol = np.column_stack([x, 4 + np.where(far, 0, y), np.full(3000, 6), 2 + (x if far else x ^ y)] if far else [np.full(3000, 6), x, 4 + y, 2 + (x ^ y)]).reshape(-1)
        rows = maxent.features(symbol, np.tile(np.arange(4), 3000))
        weights, past = maxent.start_weights(Small), np.ones(maxent._SIZE1 + maxent._SIZE2, np.float32)
        for _ in range(8):
            maxent.learn(weights, past, rows, symbol, 0.5)
        assert maxent.log_probabilities(weights, rows, symbol)[3::4].mean() > math.log10(0.9)


# Toxicity


def test_forward_backward():
    rng = np.random.default_rng(3)
    n, moves = 500, rng.normal(size=(2, 2))
    scores, first = rng.normal(size=n) * 3, np.zeros(n, bool)
    first[[0, 1, 7, 200, 201, 499]] = True
    a, b = toxicity.chain(scores, first, moves)
    ends = [*np.flatnonzero(first).tolist(), n]
    for i, j in zip(ends, ends[1:], strict=False):
        ahead, behind = np.zeros((j - i, 2)), np.zeros((j - i, 2))
        for t in range(i, j):
            here = np.array([0, scores[t]])
            ahead[t - i] = here if t == i else here + np.logaddexp(ahead[t - i - 1][0] + moves[0], ahead[t - i - 1][1] + moves[1])
        for t in range(j - 2, i - 1, -1):
            x = moves + np.array([0, scores[t + 1]]) + behind[t + 1 - i]
            behind[t - i] = np.logaddexp(x[:, 0], x[:, 1])
        assert np.allclose(ahead[:, 1] - ahead[:, 0], a[i:j]) and np.allclose(behind[:, 1] - behind[:, 0], b[i:j])


def test_held_out_toxicity(spark):
    rng = random.Random(9)
    plain, bad = ["".join(rng.choice("aeioklmnrst") for _ in range(6)) for _ in range(300)], ["nasty", "vile", "foul", "rotten"]
    rows, labels = [], []
    for k in range(600):
        words, toxic = [rng.choice(plain) for _ in range(rng.randint(20, 120))], k % 5 == 0
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad).upper() if rng.random() < 0.3 else rng.choice(bad))
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    docs, known = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    truth, texts = dict(labels), dict(rows)
    got = [r for r in toxicity.toxicity(docs, known).collect() if r.held_out]
    assert got and all(r.predicted == truth[r.doc_id] for r in got)
    for r in got:
        assert all(texts[r.doc_id][int(a) : int(b)].lower() in bad for a, b in (s.split(":") for s in r.spans.split(",") if s))


# The pipeline


def test_pipeline_against_plain_versions(spark, duck, docs):
    kept = {r[0] for r in duck.sql(f"select doc_id from ({oracle.SQL['op10_quality']}) where kept").fetchall()}
    left = [(d, t) for d, t in docs if d in kept]
    of = brute.classes(left)
    left = [(d, t) for d, t in left if of[d] == d]
    leaked = {d for d, _ in brute.leaks(left, duck.sql("select item_id, text from benchmark").fetchall())}
    left = [(d, t) for d, t in left if d not in leaked]
    ids = ", ".join(str(d) for d, _ in left)
    mix = duck.sql(oracle.SQL["op6_mixing"].replace("from documents", f"from documents where doc_id in ({ids})")).fetchall()
    copies = {r[0]: r[5] for r in mix}
    want = brute.token_rows([x for x in left for _ in range(copies[x[0]])])
    got = sorted(tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in corpus_pipeline.run(spark, DATA).collect())
    assert got == sorted(want)


# Quality fences


@pytest.mark.parametrize("ratio", ["repeat_ratio", "dup_line_ratio"])
def test_repetition_fences_reject(spark, ratio):
    rng = random.Random(7)
    line = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    rows = [(k, "\n".join(line(10) for _ in range(20)), "en", "a") for k in range(40)]
    if ratio == "repeat_ratio":  # three of ten words stand in a run that comes again, in lines that differ
        run = line(3)
        odd = "\n".join(f"{line(7)} {run}" for _ in range(20))
    else:  # a third of the lines come again; they are too short to repeat many words
        odd = "\n".join([line(1)] * 5 + [line(10) for _ in range(9)])
    docs = spark.createDataFrame([*rows, (99, odd, "en", "a")], "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.quality_report(docs).collect()}
    assert not got[99].base_failed and ratio in got[99].broken and not got[99].kept
    assert all(got[k].kept for k in range(40))


def test_toxic_words_by_brute_force(spark):
    rng = random.Random(7)
    plain = [a + b for a in "bcdfghklmn" for b in "aeiouy"]
    rows = []
    for k in range(160):
        words = [rng.choice(plain) for _ in range(30)]
        if k % 4 == 0:
            for _ in range(3):
                words.insert(rng.randrange(31), rng.choice(["Vile", "foul", "nasty"]))
            words += ["always", "copied"]  # always in the same place
        rows.append((" ".join(words), int(k % 4 == 0)))
    rows += [(None, 0), ("", 1), rows[0], rows[1]]
    train = spark.createDataFrame(rows, "text string, toxic int").repartition(3)
    n, p = len(rows), sum(toxic for _, toxic in rows)
    wanted = set()
    cut = [([w.lower() for w in (text or "").split()], toxic) for text, toxic in rows]
    for word in {w for words, _ in cut for w in words}:
        t = sum(toxic for words, toxic in cut if word in words)
        d = sum(word in words for words, _ in cut)
        odds = math.log((t + 0.5) / (p + 1)) - math.log((d - t + 0.5) / (n - p + 1))
        before = {([""] + words)[k] for words, toxic in cut if toxic for k, w in enumerate(words) if w == word}
        if t >= 5 and odds >= 3.0 and len(before) >= max(5, 0.02 * p):
            wanted.add(word)
    assert toxicity.toxic_words(train) == wanted >= {"vile", "foul", "nasty"}
    assert "copied" not in wanted
    assert toxicity.toxic_words(train.where("toxic = 0")) == set()
