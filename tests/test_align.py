"""Time alignment: against brute force, and linear in the samples of one key."""

import random
import time

from pyspark.sql import functions as F

from skein.operators import align


def test_nearest_and_placed_against_brute_force(spark):
    rng = random.Random(5)
    samples = sorted({("ab"[rng.random() < 0.3], rng.randrange(-200, 400)) for _ in range(150)})
    points = sorted({("abc"[rng.randrange(3)], rng.randrange(-250, 450)) for _ in range(80)})
    got = align.nearest(spark.createDataFrame(samples, "k string, t long"), spark.createDataFrame(points, "k string, p long"), "k", "t", "p")
    want = {(k, p, min((abs(t - p), t) for c, t in samples if c == k)[1]) for k, p in points if any(c == k for c, _ in samples)}
    assert {tuple(r) for r in got.collect()} == want
    spans = [(k, i, s, s + rng.choice([0, 1, 7, 40, 133])) for k in "ab" for i, s in enumerate(rng.randrange(-220, 400) for _ in range(40))]
    made = align.placed(spark.createDataFrame(samples, "k string, t long"), spark.createDataFrame(spans, "k string, idx long, start long, end long"), "k")
    assert sorted((r.k, r.t, r.idx) for r in made.collect()) == sorted((k, t, i) for k, t in samples for c, i, a, b in spans if c == k and a <= t < b)


def _seconds(spark, n):
    samples = spark.range(n).select(F.lit("one").alias("k"), (F.col("id") * 7).alias("t"))
    points = spark.range(n).select(F.lit("one").alias("k"), (F.col("id") * 7 + 3).alias("p"))
    spans = spark.range(n // 10).select(F.lit("one").alias("k"), F.col("id").alias("idx"), (F.col("id") * 70).alias("start"), (F.col("id") * 70 + 140).alias("end"))
    began = time.perf_counter()
    align.nearest(samples, points, "k", "t", "p").write.format("noop").mode("overwrite").save()
    align.aligned(spans, samples.withColumn("s", F.lit("x")).withColumn("v", F.col("t")), "k", "s", "v").write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def test_one_key_is_linear(spark):
    _seconds(spark, 1000)
    assert _seconds(spark, 200_000) < 40  # quadratic work took over half an hour
