import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skein.llm import minhash as M


def shingle_set(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(docs):
    """All pairs that share a shingle, exactly."""
    sets = {d: shingle_set(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = {}
    for d, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(d)
    for a, s in sets.items():
        for b in {b for x in s for b in by[x] if b < a}:
            if len(s & sets[b]) >= 0.8 * len(s | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in sets}


def test_query_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in M.op1_dart_minhash(spark, d).collect()}
    assert got == brute_classes(docs)


@pytest.mark.parametrize("block", [7, 50, 1024])
def test_hot_near_copies_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "COLUMNS", 100)
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 7)))
    base = [word() for _ in range(150)]
    docs = []
    for i in range(220):
        w = list(base)
        for _ in range(rng.randint(1, 9)):
            w[rng.randrange(len(w))] = word()
        docs.append((i, " ".join(w)))
    docs += [(1000 + i, " ".join(word() for _ in range(80))) for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in M.near_duplicates(df).collect()} == brute_classes(docs)


@pytest.mark.parametrize("weights", ["set", "count"])
def test_signatures_estimate_weighted_jaccard(weights):
    rng = np.random.default_rng(4)
    h = M.mix(np.arange(1, 301, dtype=np.uint64))
    wa, wb = (rng.integers(1, 5, 300).astype(float) if weights == "count" else np.ones(300) for _ in range(2))
    a, b = np.arange(0, 250), np.arange(50, 300)
    sig = M.dart_signatures(np.concatenate([h[a], h[b]]), np.repeat([0, 1], 250), np.concatenate([wa[a], wb[b]]), 2, k=4000)
    va, vb = np.zeros(300), np.zeros(300)
    va[a], vb[b] = wa[a], wb[b]
    want = np.minimum(va, vb).sum() / np.maximum(va, vb).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03


def test_fractional_weights_and_many_sizes():
    h = M.mix(np.arange(1, 41, dtype=np.uint64))
    sig = M.dart_signatures(np.concatenate([h, h]), np.repeat([0, 1], 40), np.concatenate([np.full(40, 0.5), np.full(40, 1.5)]), 3, k=3000)
    assert abs((sig[0] == sig[1]).mean() - 1 / 3) < 0.04 and not sig[2].any()


def test_shingles_against_brute_force():
    texts = ["A b c d e f a B c d e", "one two", "", None, "x " * 9, "é É"]
    h, row, count = M.elements(pa.array(texts), weights="count")
    for i, t in enumerate(texts):
        assert (row == i).sum() == len(shingle_set(t))
        assert count[row == i].sum() == max(0, max(1, len((t or "").split()) - 4) if (t or "").split() else 0)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.id: r.label for r in M.components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_odd_rows(spark, odd, odd_dir, none_dir):
    got = sorted((r.doc_id, r.class_id) for r in M.op1_dart_minhash(spark, odd_dir).collect())
    assert [g[0] for g in got] == sorted(r.doc_id for r in odd.collect()) and all(a == b for a, b in got)
    assert M.op1_dart_minhash(spark, none_dir).count() == 0
    assert M.keep_one(odd).columns == odd.columns


def test_query_equals_sql(spark):
    import oracle

    d = "/root/testdata/sf0.01"
    assert oracle.compare(spark, oracle.connect(d), d, M.op1_dart_minhash, M.ORACLE_SQL) == 1000


def test_one_row_for_each_row_of_an_id_with_unlike_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(7, a), (7, b), (9, a + " end"), (8, b), (5, b + " end"), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sub", F.lit(0)).withColumn("label", F.lit("x"))
    got = sorted((r.doc_id, r.class_id) for r in M.near_duplicates(df).collect())
    assert got == [(5, 5), (7, 5), (7, 7), (7, 7), (8, 5), (9, 7)]
    kept = M.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted([(7, a), (5, b + " end"), (7, "")])


def test_repeated_rows(spark):
    a = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(3, a)] * 2000 + [(4, a + " x"), (6, "alone")], "doc_id long, text string")
    rows = M.near_duplicates(df).collect()
    assert len(rows) == 2002 and {r.class_id for r in rows if r.doc_id != 6} == {3}
    assert sorted(r.doc_id for r in M.keep_one(df).collect()) == [3, 6]


def test_blocks_of_a_main_component_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 10)
    named = spark.createDataFrame([(1, i, 0) for i in range(100)] + [(1, 100 + i, 100 + i) for i in range(12)] + [(2, i, 0) for i in range(5)], "key long, id long, label long")
    mixed = M._mixed(named)
    assert [(r.key, r.main, r.n_main, r.n_rest) for r in mixed.collect()] == [(1, 0, 100, 12)]
    tasks = M._tasks(named.join(mixed, "key"), "id").collect()
    met = {(r.i, r.j) for r in tasks}
    assert met <= {(i, j) for i in range(12) for j in (10, 11) if i <= j}
    by = {}
    for r in tasks:
        by.setdefault((r.i, r.j), set()).add(r.id)
    for x in range(112):
        for y in range(100, 112):
            assert x == y or any({x, y} <= g for g in by.values())
