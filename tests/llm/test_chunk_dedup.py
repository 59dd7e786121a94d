import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import chunk_dedup as C
from skein.llm.text import SpanHash


def brute_chunks(text):
    """One byte at a time."""
    data = text.encode()
    cuts, before, h = [], None, 0
    for i, b in enumerate(data):
        h = (h * 2 + int(C.GEAR[b])) % 65536
        at = i + 1
        if at >= C.WINDOW and at < len(data) and h >> (16 - C.MASK_BITS) == 0 and data[at] & 0xC0 != 0x80:
            if before is None or at - before >= C.MIN_CHUNK:
                cuts.append(at)
            before = at
    edges, out = [0, *cuts, len(data)], []
    for a, b in zip(edges, edges[1:]):
        inner = [x for x in range(a + C.MAX_CHUNK, b, C.MAX_CHUNK)]
        inner = [next(y for y in range(x, x - 4, -1) if data[y] & 0xC0 != 0x80) for x in inner]
        out += zip([a, *inner], [*inner, b])
    return [data[a:b] for a, b in out if b > a]


def brute(docs):
    cut = [(d, brute_chunks(t or "")) for d, t in docs]
    least = defaultdict(lambda: float("inf"))
    for d, parts in cut:
        for p in parts:
            least[p] = min(least[p], d)
    out = []
    for d, parts in cut:
        seen, kept, run, n, spans = set(), [], [], 0, 0
        for p in [*parts, None]:
            if p is not None and (least[p] < d or p in seen):
                run.append(p)
                continue
            size = sum(map(len, run))
            if size >= C.MIN_RUN:
                n, spans = n + size, spans + 1
            else:
                kept += run
            run = []
            if p is not None:
                kept.append(p)
                seen.add(p)
        out.append((d, sum(map(len, parts)), len(parts), n, spans, hashlib.sha256(b"".join(kept)).hexdigest()))
    return sorted(out)


def rows(df):
    return sorted((r.doc_id, r.n_bytes, r.n_chunks, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_chunks_against_brute_force(odd, sf, spark):
    texts = [r.text or "" for r in odd.collect()] + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(30).collect()] + ["é" * 2000, "a" * 3000, "☃𝒳" * 400]
    joined = "".join(texts).encode()
    off = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    s, e, r = C.chunks(np.frombuffer(joined, np.uint8), off)
    for i, t in enumerate(texts):
        assert [joined[a:b] for a, b in zip(s[r == i], e[r == i])] == brute_chunks(t)


def test_query_against_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows(C.op9_chunk_dedup(spark, sf)) == brute(docs)


def test_odd_rows(spark, odd, odd_dir, none_dir):
    assert rows(C.op9_chunk_dedup(spark, odd_dir)) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert C.op9_chunk_dedup(spark, none_dir).count() == 0
    kept = C.dedup(odd, stats=False)
    assert kept.columns == odd.columns and sum(r.text is None for r in kept.collect()) == 2
    with pytest.raises(ValueError):
        C.dedup(odd.withColumnRenamed("score", "Chunk_Dedup"))


def planted(seed, n=60, words=51):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 7)))
    prose = lambda k: " ".join(word() for _ in range(k))
    shared = [prose(words) for _ in range(n)]
    docs = []
    for i, p in enumerate(shared):
        docs += [(10 * i + k, f"{prose(rng.randint(20, 90))} {p} {prose(rng.randint(20, 90))}") for k in (1, 2)]
        docs.append((10 * i + 5, prose(rng.randint(60, 200))))
    return docs, shared


def test_planted_passages_and_clean_documents(spark):
    docs, shared = planted(4)
    got = {r.doc_id: r for r in C.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    texts = dict(docs)
    caught = [got[10 * i + 2].text != texts[10 * i + 2] and p not in got[10 * i + 2].text for i, p in enumerate(shared)]
    assert np.mean(caught) >= 0.97
    assert all(got[d].text == t for d, t in docs if d % 10 != 2)
    assert all(got[10 * i + 2].chunk_dedup.first_ids == [10 * i + 1] for i in range(len(shared)) if caught[i])


def test_insertions_move_few_chunks():
    docs, _ = planted(9, 1, 400)
    text = docs[0][1]
    a, b = set(brute_chunks(text)), set(brute_chunks(text[:700] + "X inserted " + text[700:]))
    assert len(a - b) <= 4


def test_digests_differ():
    data = np.frombuffer(b"abcabd", np.uint8)
    h = SpanHash(data)(np.array([0, 3, 0]), np.array([3, 6, 2]))
    assert len(set(h.tolist())) == 3


def test_many_repeated_rows_with_clashing_columns(spark):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh ") for _ in range(700))
    df = spark.createDataFrame([(3, text, 1)] * 2000 + [(5, text, 2)], "doc_id long, text string, __copies int").withColumn("__id", F.lit(0)).withColumn("digest", F.lit("x"))
    made = C.dedup(df, stats=False)
    assert made.columns == df.columns
    rows = made.collect()
    assert len(rows) == 2001 and all(r.text == text for r in rows if r.doc_id == 3) and [r.text for r in rows if r.doc_id == 5] == [""]
