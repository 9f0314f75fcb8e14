"""Nulls, empty and very long texts, repeated rows, ties, empty tables and clashing columns, for every operator."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from haulmetry.llm import archive, decontam, linedup, maxent, minhash, mixing, quality, secrets, tokenfile, toxicity

#: Names that operators use inside; the input may have them too.
CLASHES = "row m t w l g at runs size place copies last bucket key band bands node root id h lines words h_ score target item_id h2 toxic part uid".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in CLASHES)


def _words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


def _rows():
    long = _words(20_000, 999)
    plain = [_words(120, k) + ".\n" + _words(60, 100 + k) for k in range(6)]
    texts = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \n\t ", None, "a"),
        (4, "one", "en", None),
        (None, plain[0], "en", "b"),
        (5, long, "en", "b"),
        (6, plain[1], "en", "b"),
        (6, plain[1], "en", "b"),
        (7, plain[1], None, None),
        (8, plain[2], "de", "c"),
        (8, plain[3], "de", "c"),
        (9, "é" * 3000 + "\n" + plain[4], "fr", "c"),
        (None, None, None, None),
    ]
    return [(*t, len(t[1] or ""), *["x"] * len(CLASHES)) for t in texts]


@pytest.fixture(scope="module")
def messy(spark):
    return spark.createDataFrame(_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark, messy):
    text = _rows()[6][1]
    return spark.createDataFrame(
        [(1, " ".join(text.split()[10:40])), (2, None), (3, ""), (None, "a b c d e f"), (4, "one"), (4, "one")],
        "item_id bigint, text string",
    )


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(6, 1), (6, 0), (8, 0), (None, 1), (5, None)], "doc_id bigint, toxic int")


def test_quality(messy, empty):
    rows = quality.quality_report(messy).collect()
    assert len(rows) == len(_rows()) and sum(r.kept for r in rows) == sum(not r.base_failed and not r.broken for r in rows)
    assert all(r.base_failed and r.n_words == 0 for r in rows if r.doc_id in (1, 2, 3))
    kept = quality.keep_good(messy)
    assert kept.schema.simpleString() == messy.schema.simpleString() and kept.count() == sum(r.kept for r in rows)
    assert quality.quality_report(empty).count() == quality.keep_good(empty).count() == 0


def test_mixing(messy, empty):
    rows = mixing.mixed(messy).collect()
    assert len(rows) == len(_rows())
    assert all(0 <= r.copies <= 2 for r in rows)
    twice = [r.copies for r in rows if r.row.doc_id == 6]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert mixing.mixture(messy).count() == sum(r.copies for r in rows)
    assert mixing.mixed(empty).count() == mixing.mixture(empty).count() == 0


def test_near_duplicates(messy, empty):
    rows = minhash.near_duplicates(messy).collect()
    assert len(rows) == len(_rows())
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, set()).add(r.class_id)
    assert found[1] == {1} and found[2] == {2} and found[3] == {3}
    assert found[6] == found[7] == {6}
    kept = minhash.one_of_each(messy)
    assert kept.columns == messy.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 2, 3, 4, 5, 6, 8, 8, 9] and ids.count(None) == 2
    assert minhash.near_duplicates(empty).count() == minhash.one_of_each(empty).count() == 0


def test_near_duplicates_by_text(spark):
    """Rows without id, and several texts of one id, are told apart by their texts."""
    one, two, three = (_words(200, 500 + k) for k in range(3))
    rows = [(None, one), (3, one), (None, one + " end"), (4, two), (4, three), (5, three), (None, _words(50, 600)), (None, _words(50, 600))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted((r.doc_id or 0, r.class_id or 0) for r in minhash.near_duplicates(docs).collect())
    assert found == [(0, 0), (0, 0), (0, 3), (0, 3), (3, 3), (4, 4), (4, 4), (5, 4)]
    kept = [(r.doc_id, r.text) for r in minhash.one_of_each(docs).collect()]
    assert sorted(kept, key=str) == sorted([(3, one), (4, two), (4, three), (None, _words(50, 600))], key=str)


def test_decontamination(messy, empty, items):
    rows = {(r.doc_id, r.item_id) for r in decontam.contaminated(messy, items).collect()}
    assert rows == {(6, 1), (7, 1), (4, 4)}
    left = decontam.decontaminated(messy, items)
    assert left.columns == messy.columns and left.count() == len(_rows()) - 4
    unnamed = messy.where("doc_id = 6").withColumn("doc_id", F.lit(None).cast("bigint"))
    assert decontam.decontaminated(unnamed.union(messy.where("doc_id = 8")), items).count() == 2
    assert decontam.contaminated(empty, items).count() == 0
    assert decontam.contaminated(messy, items.limit(0)).count() == 0
    assert decontam.decontaminated(messy, items.limit(0)).count() == len(_rows())


def test_tokens(messy, empty):
    rows = tokenfile.read_tokens(tokenfile.write_tokens(messy)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((r[0] for r in _rows()), key=lambda x: (x is not None, x))
    ahead = 0
    for r in rows:
        assert r.start == ahead
        ahead += r.n_tokens
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {1}
    assert tokenfile.read_tokens(tokenfile.write_tokens(empty)).count() == 0


def test_line_dedup(messy, empty):
    rows = linedup.line_dedup(messy).collect()
    assert len(rows) == len(_rows())
    removed = {(r.doc_id, r.n_removed) for r in rows}
    assert (7, 2) in removed and (6, 0) in removed and (1, 0) in removed
    assert linedup.line_dedup(empty).count() == 0


def test_secrets(messy, empty):
    rows = secrets.secrets(messy).collect()
    assert len(rows) == len(_rows()) and all(r.n_assign == r.n_access == 0 for r in rows)
    assert secrets.secrets(empty).count() == 0


def test_toxicity(messy, empty, labels):
    rows = toxicity.toxicity(messy, labels).collect()
    assert len(rows) == len(_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert all(r.score == pytest.approx(0, abs=1e-5) for r in toxicity.toxicity(messy, labels.limit(0)).collect())
    assert toxicity.toxicity(empty, labels).count() == 0


def test_language_model(messy, empty):
    rows = maxent.scores(messy).collect()
    assert len(rows) == len(_rows()) and all(r.score < 0 and r.base_score < 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert maxent.scores(empty).count() == 0


def test_archive(spark):
    schema = "page_id bigint, url string, html string, path string, digest string, n int"
    made = [
        (1, "http://a/ b\n", "<p>é</p>", "x", "y", 1),
        (2, None, "<p>é</p>", "x", "y", 1),
        (2, None, "<p>é</p>", "x", "y", 1),
        (3, "", None, "x", "y", 1),
        (4, "http://c", "", "x", "y", 1),
        (None, "http://d", "", "x", "y", 1),
        (5, "http://e", "HTTP/1.1 200 OK\r\n\r\n" + "x" * 3_000_000, "x", "y", 1),
    ]
    pages = spark.createDataFrame(made, schema)
    for version in (1, 2):
        rows = archive.read_warc(archive.convert(archive.write_arc(pages, version=version))).collect()
        assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in rows) == [
            (0, "response", 0),
            (1, "revisit", 2),
            (2, "response", 0),
            (2, "revisit", 2),
            (3, "revisit", 4),
            (4, "response", 0),
            (5, "response", 0),
        ]
        assert {r.page_id: r.payload_bytes for r in rows}[5] == len(made[-1][2])
    assert archive.read_warc(archive.convert(archive.write_arc(pages.limit(0)))).count() == 0


def test_pipeline(spark, messy, empty, items, tmp_path):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (messy, empty):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == columns, name
        docs = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        docs.count()
