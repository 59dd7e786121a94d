import re

import pytest
from test_chunk_dedup import brute as brute_chunks
from test_minhash import brute_classes
from test_packing import check
from test_secret_scan import KEY

import corpus_pipeline as P
from skein.llm import quality_knn

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def staged(spark):
    d = "/root/testdata/sf0.01"
    docs, out = spark.read.parquet(f"{d}/documents.parquet"), []
    for _, stage in P.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, d).collect())
        out.append(docs)
    return spark.read.parquet(f"{d}/documents.parquet"), out


def pairs(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_names_and_columns(staged):
    _, out = staged
    assert len(P.STAGES) == 5 and all(df.columns == NAMES for df in out[:-1])
    assert all(r.n_chars == len(r.text) for df in out[:-1] for r in df.collect())


def test_quality(staged, spark):
    docs, out = staged
    scores = quality_knn.score(docs, quality_knn.learned(spark, docs, "/root/testdata/sf0.01"))
    assert set(pairs(out[0])) == {r.doc_id for r in scores.collect() if r.predicted}
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    good = [d for d, y in labels.items() if y == 1]
    assert len(set(good) & set(pairs(out[0]))) >= 0.99 * len(good)
    assert len(pairs(out[0])) < docs.count()


def test_one_of_each_near_duplicate_class_stays(staged):
    _, out = staged
    classes = brute_classes(list(pairs(out[0]).items()))
    assert set(pairs(out[1])) == {d for d, c in classes.items() if d == c}


def test_passages_are_cut(staged):
    import hashlib

    _, out = staged
    want = {d: h for d, *_, h in brute_chunks(list(pairs(out[1]).items()))}
    empty = hashlib.sha256(b"").hexdigest()
    got = {d: hashlib.sha256(t.encode()).hexdigest() for d, t in pairs(out[2]).items()}
    assert got == {d: h for d, h in want.items() if h != empty}


def test_secrets_are_gone(staged):
    _, out = staged
    before, after = pairs(out[2]), pairs(out[3])
    assert before.keys() == after.keys()
    secret = re.compile("AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}")
    assert not any(secret.search(t) for t in after.values())
    for d, t in before.items():
        assert after[d] == t or "[SECRET]" in after[d]


def test_packed(staged):
    _, out = staged
    check(out[4].collect(), list(pairs(out[3]).items()))


def test_run_and_odd_rows(spark, odd_dir, none_dir):
    assert P.run(spark, odd_dir).columns[:2] == ["doc_id", "piece"]
    assert P.run(spark, none_dir).count() == 0


def test_redaction_in_a_stage(spark, sf):
    docs = spark.createDataFrame([(1, f"a {KEY} b", None, None, 24), (2, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in P.redact_secrets(spark, docs, sf).collect()}
    assert got == {1: ("a [SECRET] b", 12), 2: (None, None)}


def test_documents_that_came_in_empty_stay(spark, sf):
    line = " ".join(f"word{k * k} of passage {k}" for k in range(30))
    rows = [(1, line, None, None, len(line)), (2, line, None, None, len(line)), (3, "", None, None, 0), (3, "", None, None, 0), (4, None, None, None, None), (None, "", None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = P.cut_shared_passages(spark, docs, sf)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(1, line), (3, ""), (3, ""), (4, None), (None, "")], key=str)
