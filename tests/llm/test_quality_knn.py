import zlib

import numpy as np
from pyspark.sql import functions as F

from skein.llm import quality_knn as Q


def test_held_out_quality(spark):
    d = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in Q.op4_quality_votes(spark, d).collect()}
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.values())
    held = [(got[r.doc_id], r.quality) for r in spark.read.parquet(f"{d}/labels.parquet").collect() if got[r.doc_id].held_out]
    good = [r.predicted for r, y in held if y == 1]
    bad = [r.predicted for r, y in held if y == 0]
    pairs = [(g.score > b.score) + (g.score == b.score) / 2 for g, y in held if y == 1 for b, z in held if z == 0]
    print(np.mean(good), np.mean(bad), np.mean(pairs))
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.2 and np.mean(pairs) >= 0.97


def test_votes_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    docs = spark.createDataFrame(rows)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = Q.fit(docs, labels)
    assert len(model.labels) == labels.count()
    got = {r.doc_id: r.score for r in Q.score(docs, model).collect()}
    for r in rows:
        data = np.frombuffer(r.text.encode(), np.uint8)
        v = model._unit(model._weighted(Q.term_counts(data, np.array([0, len(data)]))) @ model.basis)[0]
        ranked = sorted(((float(u @ v), i) for i, u in enumerate(model.vectors)), reverse=True)[: Q.NEIGHBOURS]
        w = [max(c, 0) ** Q.SHARPNESS + 1e-9 for c, i in ranked]
        want = sum(a * model.labels[i] for a, (_, i) in zip(w, ranked)) / sum(w)
        assert abs(got[r.doc_id] - want) < 1e-3


def test_repetition_marks():
    data = np.frombuffer(b"aa aa bb aa", np.uint8)
    c = Q.term_counts(data, np.array([0, 5, 11]))
    assert c[0, :2].tolist() == [1, 1] and c[1, :2].tolist() == [0, 0]
    assert c[0, 2 : Q.TERMS - Q.WORDS].sum() == 3 and c[:, Q.TERMS - Q.WORDS :].sum(1).tolist() == [2, 2]


def test_odd_rows(spark, odd, odd_dir, none_dir):
    got = Q.op4_quality_votes(spark, odd_dir).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert Q.op4_quality_votes(spark, none_dir).count() == 0
    assert {r.score for r in Q.score(odd, Q.fit(odd, spark.createDataFrame([], "doc_id long, quality int"))).collect()} == {0.5}
    model = Q.fit(odd, spark.createDataFrame([(6, 0), (6, 0), (5, 1), (5, None)], "doc_id long, quality int"))
    assert Q.keep_good(odd, model).columns == odd.columns


def test_repeated_ids_are_learned_once(spark):
    text = lambda k: f"a text of plain words number {k} " * 4
    docs = spark.createDataFrame([(1, text(1))] * 3000 + [(1, None), (2, text(2)), (3, "### $$ %% " * 9), (None, text(4))], "doc_id long, text string").withColumn("y", F.lit(0)).withColumn("id", F.lit("x"))
    labels = spark.createDataFrame([(1, 1)] * 500 + [(2, 1), (3, 0), (None, 0), (3, None)], "doc_id long, quality int")
    model = Q.fit(docs, labels)
    assert model.labels.tolist() == [1, 1, 0] and model.prior == 2 / 3
    made = Q.score(docs, model).collect()
    assert len(made) == 3004 and {r.predicted for r in made if r.doc_id == 3} == {0}
