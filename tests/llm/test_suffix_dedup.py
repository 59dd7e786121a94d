import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import suffix_dedup as S


def brute(docs, length=200):
    seen = Counter()
    bodies = [(d, (t or "").encode()) for d, t in docs]
    for _, b in bodies:
        for i in range(len(b) - length + 1):
            seen[hashlib.blake2b(b[i : i + length], digest_size=12).digest()] += 1
    out = []
    for d, b in bodies:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[hashlib.blake2b(b[i : i + length], digest_size=12).digest()] > 1:
                gone[i : i + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]]) if len(b) else b""
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_query_against_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows(S.op5_suffix_dedup(spark, sf)) == brute(docs)


def test_odd_rows(spark, odd, odd_dir, none_dir):
    assert rows(S.op5_suffix_dedup(spark, odd_dir)) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert S.op5_suffix_dedup(spark, none_dir).count() == 0


def tricky(seed):
    """Overlapping, shifted, periodic and barely too short repeats; a common line in other contexts; repeated rows."""
    rng = random.Random(seed)
    prose = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    a, b, line = prose(420), prose(300), prose(150)
    docs = [(1, prose(50) + a + prose(60)), (2, prose(33) + a[100:350] + prose(10)), (3, a[:199] + prose(80)), (4, a[200:] + b), (5, b[:230] + a[:230])]
    docs += [(6, "xy" * 400), (7, "q" * 199), (8, "q" * 200), (9, prose(20) + "xyx" * 100), (10, b), (10, b), (11, b), (11, prose(300))]
    docs += [(20 + i, prose(rng.randint(0, 100)) + line + prose(rng.randint(0, 100))) for i in range(40)]
    docs += [(70 + i, prose(90)[: rng.randint(1, 90)] + line + a[i : i + 70] + prose(5)) for i in range(10)]
    docs += [(90, "\0" * 230), (91, "\0" * 205 + "a"), (92, "a" + "\0" * 201), (None, b), (None, prose(250))]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("hot, part", [(1, 1 << 24), (50_000, 1 << 24), (50_000, 1)])
def test_tricky_repeats(spark, monkeypatch, seed, hot, part):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "PART", part)
    docs = tricky(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    made = S.cut_out(df).collect()
    got = Counter((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in made)
    want = Counter((None if d == -1 else d, *x) for d, *x in brute([(-1 if d is None else d, t) for d, t in docs]))
    assert got == want


def test_pieces_do_not_matter(monkeypatch):
    rng = np.random.default_rng(2)
    data = rng.integers(97, 101, 5000, dtype=np.uint8)
    off = np.array([0, 0, 900, 1000, 5000])

    def strings():
        row, start, n, m, kmer, _ = S.segments(data, off)
        return {(r, s + j): (m_ - j, k) for r, s, n_, m_, k in zip(row, start, n, m, kmer) for j in range(n_)}

    whole = strings()
    assert len(whole) == 900 - 199 + 4000 - 199
    monkeypatch.setattr(S, "PIECE", 333)
    assert strings() == whole


def test_multikey_order_against_sorted():
    rng = np.random.default_rng(3)
    text = [bytes(rng.integers(0, 3, rng.integers(0, 17), dtype=np.uint8)) for _ in range(500)]
    group = rng.integers(0, 4, 500)
    length = np.array([len(t) for t in text])
    matrix = np.array([list(t.ljust(16, b"\0")) for t in text], np.uint8)
    order, lcp = S._sorted_prefixes(matrix, length, group)
    assert [(group[i], text[i]) for i in order] == sorted(zip(group.tolist(), text))
    for k in range(1, 500):
        a, b = text[order[k - 1]], text[order[k]]
        want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert lcp[k] == (want if group[order[k]] == group[order[k - 1]] else -1)


@pytest.mark.parametrize("seed", [3, 4])
def test_multikey_quicksort_against_sorted(seed):
    rng = np.random.default_rng(seed)
    words = rng.choice(np.array([0, 1, 7, 2**63, 2**64 - 1], np.uint64), (900, 4)) * (rng.random((900, 4)) < 0.7)
    group, lengths = rng.integers(0, 30, 900), rng.integers(0, 3, 900)
    order = S.multikey_order(words.astype(np.uint64), lengths, group)
    key = [(int(g), *map(int, w), int(n)) for g, w, n in zip(group, words, lengths)]
    assert sorted(order.tolist()) == list(range(900)) and [key[i] for i in order] == sorted(key)
    assert S.multikey_order(np.zeros((0, 4), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)).tolist() == []


def test_many_repeated_rows_with_clashing_columns(spark):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh ") for _ in range(700))
    docs = [(3, text)] * 2000 + [(4, "alone " * 20)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("id", "sub", "kmer", "spans", "n_bytes"):
        df = df.withColumn(name, F.lit("x"))
    made = S.cut_out(df, "doc_id", "text").select("doc_id", F.size("spans").alias("n"), F.length("kept").alias("left")).collect()
    assert len(made) == 2001 and {(r.n, r.left) for r in made if r.doc_id == 3} == {(1, 0)} and [(r.n, r.left) for r in made if r.doc_id == 4] == [(0, 120)]


def test_boundaries_are_compared(spark):
    runs = lambda *edges: spark.createDataFrame([(1, 5, [0, 2], None), *((None, k, None, [bytearray(x) for x in e]) for k, e in edges)], S.RUNS)
    S.compare_boundaries(runs((0, (b"a", b"c")), (3, (b"d", b"d")), (10, (b"e", b"f"))))
    with pytest.raises(RuntimeError, match="parts suffixes"):
        S.compare_boundaries(runs((10, (b"c", b"f")), (2, (b"a", b"c"))))


def test_every_bucket_hands_out_its_edges(spark, sf, monkeypatch):
    seen = []
    kept = S.compare_boundaries
    monkeypatch.setattr(S, "compare_boundaries", lambda runs: (seen.extend(runs.filter("edge is not null").collect()), kept(runs))[1])
    S.op5_suffix_dedup(spark, sf).count()
    leads = [bytes(x) for r in sorted(seen, key=lambda r: r.whole) for x in r.edge]
    assert leads and leads == sorted(leads) and all(len(x) == S.KMER for x in leads)
