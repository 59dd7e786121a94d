import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from skein.llm import quality_rules as Q

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    three = list(zip(words, words[1:], words[2:]))
    often = {t for t, c in Counter(three).items() if c > 1}
    covered = {i + k for i, t in enumerate(three) if t in often for k in range(3)}
    lines, dup = [], 0
    for line in text.split("\n"):
        dup += bool(WORD.search(line)) and line in lines
        lines.append(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_base_against_brute_force(spark, sf, odd):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + ["a b a b a b", "x\nx\nx \nx", "a b c\x0ba b c", "é#é", " <>"] + [r.text for r in odd.collect() if r.doc_id != 6]
    f = Q.features(pa.array(texts))
    got = list(zip(*(f[c].tolist() for c in Q.COUNTS)))
    assert got == [brute_base(t) for t in texts]


def test_words_against_brute_force():
    text = "The cat, and THE dog é # 12\nof x!"
    f = Q.features(pa.array([text, ""]))
    assert f["chars"][1].sum() == 0 and f["chars"][0].sum() == len(text) and f["word_row"].tolist() == [0] * 10
    lowered = [w.encode().lower().decode() for w in WORD.findall(text)]
    alone = Q.features(pa.array(lowered))["word_bucket"]
    assert f["word_bucket"].tolist() == alone.tolist() and len(set(alone.tolist())) == len(set(lowered))


def char_class(c):
    known = {**dict.fromkeys(" \t\x0b\x0c\r", "space"), "\n": "newline", **dict.fromkeys(".,;:?'\"()-", "stop"), **dict.fromkeys("!/_@=+[]{}\\^~`", "mark"), **dict.fromkeys("#*$%&|<>", "symbol")}
    if c in known:
        return known[c]
    if c.isascii():
        return "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "other"
    return "latin" if "\u00c0" <= c <= "\u017f" else "other"


def distance(a, b):
    """Jensen-Shannon distance of two counters, by definition."""
    if not a:
        return 0.0
    na, nb, total = sum(a.values()), sum(b.values()), 0.0
    for k in {*a, *b}:
        p, q = a[k] / na, b[k] / nb
        m = (p + q) / 2
        total += sum(x * math.log2(x / m) for x in (p, q) if x) / 2
    return math.sqrt(max(0.0, total))


def brute_verdicts(rows):
    """(doc_id, kept, char distance, word distance) of every row, from the corpus' own references."""
    words = [[w.encode().lower() for w in WORD.findall(t or "")] for _, t, _ in rows]
    base = [brute_base(t) for _, t, _ in rows]
    failed = [b[0] < 50 or 100 * b[4] > 50 * b[0] for b in base]
    langs = Counter(g for *_, g in rows if g is not None)
    known = [g for g, n in langs.items() if n * Q.LEAST_SHARE >= len(rows)]
    hashed = lambda w: int(Q.features(pa.array([w.decode()]))["word_bucket"][0])
    bucket = {w: hashed(w) for w in {w for ws in words for w in ws}}
    counts = {g: Counter(bucket[w] for ws, (_, _, x), f in zip(words, rows, failed) if x == g and not f for w in ws) for g in known}
    common = {b for g in known for b, _ in sorted(counts[g].items(), key=lambda x: (-x[1], x[0]))[: Q.COMMON]}
    histograms = [(Counter(char_class(c) for c in t or ""), Counter(b if (b := bucket[w]) in common else None for w in ws)) for (_, t, _), ws in zip(rows, words)]
    refs = {}
    for g in known:
        own = [h for h, (_, _, x), f in zip(histograms, rows, failed) if x == g and not f]
        if own:
            refs[g] = sum((c for c, _ in own), Counter()), sum((w for _, w in own), Counter())
    out = []
    for (d, t, g), (c, w), f in zip(rows, histograms, failed):
        far_c = min((distance(c, r[0]) for r in refs.values()), default=0.0)
        far_w = min((distance(w, r[1]) for r in refs.values()), default=0.0)
        few_c, few_w = sum(c.values()) < Q.MIN_CHARS, sum(w.values()) < Q.MIN_WORDS
        bad = not few_c and far_c > Q.MAX_CHAR_DISTANCE or not few_w and far_w > Q.MAX_WORD_DISTANCE or not few_c and not few_w and far_c + far_w > Q.MAX_SUM_DISTANCE
        out.append((d, not f and not (bad and (g is None or g in refs)), round(far_c, 6), round(far_w, 6)))
    return sorted(out, key=repr)


def test_verdicts_against_brute_force(spark, sf):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.kept, round(r.char_distance, 6), round(r.word_distance, 6)) for r in Q.op2_quality_rules(spark, sf).collect()), key=repr)
    assert got == brute_verdicts(rows) and len({k for _, k, _, _ in got}) == 2


def test_references_are_the_corpus_own(spark):
    """Any language is a reference if the corpus has enough of it; one of a few rows is not compared; junk is rejected."""
    rng = random.Random(3)
    prose = {g: lambda g=g: " ".join(rng.choice(VERSE[g].split()) for _ in range(120)) for g in VERSE}
    junk = " ".join(f"#{rng.randrange(10**6)}$|{rng.choice('%&*')}" for _ in range(120))
    rows = [(i, prose["it"](), "it") for i in range(60)] + [(100 + i, prose["ru"](), "ru") for i in range(60)] + [(200, prose["en"](), None), (300, junk, "it"), (301, junk, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("chars", F.lit(1)).withColumn("n_words", F.lit("x"))
    common = Q.common_words(df)
    assert sorted(common) == ["it", "ru"]
    found = Q.extract(df, common)
    kept = {r.doc_id: r.kept for r in Q.judge(found, Q.references(found, common)).collect()}
    assert all(kept[d] for d, _, _ in rows[:120]) and not kept[300] and not kept[301]
    rare = df.union(spark.createDataFrame([(400, prose["en"](), "en", 1, "x")] * 1, df.schema)).union(spark.range(1000, 3000).select("id", F.lit("short"), F.lit("it"), F.lit(1), F.lit("x")))
    common = Q.common_words(rare)
    found = Q.extract(rare, common)
    assert "en" not in common and {r.doc_id: r.kept for r in Q.judge(found, Q.references(found, common)).collect()}[400]


VERSE = {
    "it": "nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita",
    "ru": "я помню чудное мгновенье передо мной явилась ты как мимолётное виденье как гений чистой красоты",
    "en": "shall i compare thee to a summer's day thou art more lovely and more temperate rough winds do shake",
}


def test_distance_against_definition():
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x)
    got = Q.js_distance(np.array([[2, 2, 0], [0, 0, 0]]), np.array([1, 1, 2]))
    assert abs(got[0] - math.sqrt((kl(p) + kl(q)) / 2)) < 1e-12 and got[1] == 0


def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = Q.op2_quality_rules(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        base = brute_base(docs[r.doc_id])
        assert tuple(r)[1:6] == base
        assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert not (r.base_failed and r.kept)


def test_verdicts_on_labels(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in Q.op2_quality_rules(spark, d).collect()}
    labels = spark.read.parquet(f"{d}/labels.parquet").collect()
    good = [got[r.doc_id].kept for r in labels if r.quality == 1 and not got[r.doc_id].base_failed]
    bad = [got[r.doc_id].kept for r in labels if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_odd_rows(spark, odd, odd_dir, none_dir):
    got = Q.op2_quality_rules(spark, odd_dir).collect()
    assert len(got) == odd.count() and all(r.base_failed for r in got)
    assert Q.op2_quality_rules(spark, none_dir).count() == 0
