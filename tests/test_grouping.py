"""Folds over partitions against the plain loop."""

import random

import pytest

from skein.operators import grouping


def brute(rows, target, rule):
    out, at, group, so_far = {}, object(), 0, 0
    for k, o, n in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1])):
        n = n or 0
        if k != at:
            at, group, so_far = k, 0, n
        elif (so_far + n > target) if rule == grouping.BEFORE else so_far >= target:
            group, so_far = group + 1, n
        else:
            so_far += n
        out[k, o] = group
    return out


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("rule", [grouping.BEFORE, grouping.AFTER])
def test_folds_over_many_partitions(spark, seed, rule):
    rng = random.Random(seed)
    keys = [["a"], ["a", "b", "c"], [None, "x"], ["a", "z"] + list("bcdefgh"), ["a"], ["a", "b"]][seed]
    weights = [30] + [1] * (len(keys) - 1)
    size = [lambda: rng.randint(0, 9), lambda: rng.choice([0, 0, 100]), lambda: rng.choice([None, 3, 50, 1]), lambda: 1, lambda: rng.randint(30, 60), lambda: rng.randint(0, 3)][seed]
    rows = [(rng.choices(keys, weights)[0], o, size()) for o in range(400)]
    target = [40, 60, 20, 7, 50, 300][seed]
    df = spark.createDataFrame(rows, "k string, o long, n long").repartition(3)
    fold = grouping.packed if rule == grouping.BEFORE else grouping.closed_on_reach
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = fold(df, "k", ["o"], "n", target)
        assert {(r.k, r.o): r.group_no for r in made.collect()} == brute(rows, target, rule)
        assert made.columns == ["k", "o", "n", "group_no"]
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_no_rows(spark):
    assert grouping.packed(spark.createDataFrame([], "k string, o long, n long"), "k", ["o"], "n", 5).count() == 0
