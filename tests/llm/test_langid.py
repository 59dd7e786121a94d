import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import langid as L


@pytest.fixture(scope="module")
def predicted(spark):
    d = "/root/testdata/sf0.01"
    return L.op3_language_id(spark, d).collect(), {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").collect()}


def test_held_out_accuracy(predicted):
    rows, truth = predicted
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 5, 9, 30):
        code = L.codewords(n)
        far = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert far >= (1 if n == 2 else 2)
    assert (L.codewords(4)[0] != L.codewords(4)[1]).sum() == 4


def test_grams_stay_inside_texts():
    data = np.frombuffer(b"abcab", np.uint8)
    b, r = L.grams(data, np.array([0, 3, 3, 5]))
    assert r.tolist() == [0, 0, 2, 0] and b[0] == b[2]
    assert len(L.grams(data[:1], np.array([0, 1]))[0]) == 0


def test_decoding_corrects_a_wrong_bit():
    model = L.Model(list("abcd"), {g: np.bincount([i], minlength=L.BUCKETS) for i, g in enumerate("abcd")})
    m = model.code.astype(float) * 5
    m[:, 0] *= -1
    assert model.decode(m)[0].tolist() == [0, 1, 2, 3]


def test_odd_rows(spark, odd, odd_dir, none_dir):
    got = L.op3_language_id(spark, odd_dir).collect()
    assert len(got) == odd.count()
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und >= {1, 2, 3, 7, 8} and not und & {6}
    assert L.op3_language_id(spark, none_dir).count() == 0
    assert {r.lang_pred for r in L.predict(odd, L.Model([], {})).collect()} == {"und"}


def brute_grams(text):
    """Buckets of the 2- and 3-grams of a text's bytes, capitals lowered and digits as one value."""
    low = [48 if 48 <= b <= 57 else b + 32 if 65 <= b <= 90 else b for b in text.encode()]
    out = []
    for n in (2, 3):
        for i in range(len(low) - n + 1):
            code = n
            for b in low[i : i + n]:
                code = (code << 8 | b) % 2**32
            out.append(code * 0x9E3779B1 % 2**32 >> 18)
    return out


def brute_bits(rows, languages, code):
    """Log-odds of every bucket and bit from (text, lang) rows, language by language."""
    counts = {g: collections.Counter(b for t, x in rows if x == g for b in brute_grams(t)) for g in languages}
    share = {g: lambda b, c=c, n=sum(c.values()): (c[b] + 0.5) / (n + 0.5 * L.BUCKETS) for g, c in counts.items()}

    def odds(bucket, bit):
        sides = [[share[g](bucket) for g, word in zip(languages, code) if word[bit] == sign] for sign in (1, -1)]
        return math.log(sum(sides[0]) / len(sides[0])) - math.log(sum(sides[1]) / len(sides[1]))

    return odds


def brute_decode(model, margins):
    """Language and score by the definition of loss-weighted decoding."""
    losses = []
    for word in model.code.tolist():
        loss = [t * math.log1p(math.exp(-c * max(-30, min(30, s * m + o)))) for c, m, s, o, t in zip(word, margins, model.slope, model.offset, model.trust)]
        losses.append(sum(loss) / sum(model.trust))
    best = losses.index(min(losses))
    p = [math.exp(-(x - losses[best]) * len(margins)) for x in losses]
    close = sorted(losses)[1] - losses[best] < L.MARGIN
    return model.languages[best], 1 / sum(p), close


def test_bits_and_decoding_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.substring("text", 1, 400).alias("text"), "lang")
    rows = docs.collect()
    model = L.fit(docs)
    odds = brute_bits([(r.text, r.lang) for r in rows], model.languages, model.code)
    rng = np.random.default_rng(1)
    for b, k in zip(rng.integers(0, L.BUCKETS, 300), rng.integers(0, model.code.shape[1], 300)):
        assert abs(model.weights[b, k] - odds(int(b), int(k))) < 1e-4
    made = {r.doc_id: r for r in L.predict(docs, model).collect()}
    for r in rows[:60]:
        of = [brute_grams(r.text)] * model.code.shape[1]
        margins = [sum(float(model.weights[b, k]) for b in bs) / max(1, len(bs)) for k, bs in enumerate(of)]
        if any(c.isalpha() for c in r.text):
            lang, score, close = brute_decode(model, margins)
            assert (made[r.doc_id].lang_pred, made[r.doc_id].ambiguous) == (lang, close) and abs(made[r.doc_id].score - score) < 1e-6
        else:
            assert made[r.doc_id].lang_pred == "und"


def test_calibration_is_from_rows_that_the_odds_have_not_seen(spark, monkeypatch):
    seen = []
    kept = L.Model.calibrate
    monkeypatch.setattr(L.Model, "calibrate", lambda self, m, langs: (seen.append(len(langs)), kept(self, m, langs)))
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words of "), F.col("id")).alias("text"), F.when(F.col("id") % 2 == 0, "aa").otherwise("bb").alias("lang"))
    L.fit(docs)
    L.fit(docs, rows=1000)
    assert 850 < seen[0] < 1150 and 180 < seen[1] < 320


def test_more_languages_than_a_few(spark):
    """Seventy languages of their own letters, one row of each left out of the fit."""
    rng = np.random.default_rng(5)
    letters = {f"l{k:02d}": "".join(chr(0x4E00 + 40 * k + i) for i in range(40)) for k in range(70)}
    text = lambda g: "".join(rng.choice(list(letters[g]), 60))
    learn = spark.createDataFrame([(i, text(g), g) for i, g in enumerate(list(letters) * 6)], "doc_id long, text string, lang string")
    model = L.fit(learn)
    assert len(model.languages) == 70
    made = L.predict(spark.createDataFrame([(i, text(g)) for i, g in enumerate(letters)], "doc_id long, text string"), model).collect()
    assert sum(r.lang_pred == f"l{r.doc_id:02d}" for r in made) >= 66


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "un texte ordinaire", "fr", 1), (2, "an ordinary text", "en", 2)], "doc_id long, text string, lang string, later int").withColumn("m", F.lit(0)).withColumn("lang_pred", F.lit("x"))
    assert {r.lang_pred for r in L.predict(docs, L.fit(docs)).collect()} == {"en", "fr"}
