"""Routing filters: a rejected row keeps its place and gets a reason in ``stage_rejected``; later filters see kept rows only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.text import tolerant_map

REJECTED = "stage_rejected"


def reject(rows: DataFrame, fails: Column, stage: str) -> DataFrame:
    """``rows`` with ``stage`` as the reason of those that fail and were kept so far; a null verdict passes."""
    before = F.col(REJECTED) if REJECTED in rows.columns else F.lit(None).cast("string")
    return rows.withColumn(REJECTED, F.when(before.isNull() & fails, F.lit(stage)).otherwise(before))


def aesthetic(scores: Column, threshold: float, reduction: str = "min") -> Column:
    """Whether the reduced frame scores miss the threshold; no scores count as -1."""
    total = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x)
    value = F.array_min(scores) if reduction == "min" else total / F.nullif(F.size(scores), F.lit(0))
    return F.coalesce(value, F.lit(-1.0)) < threshold


def motion(mean: Column, patch: Column, least_mean: float, least_patch: float, score_only: bool = False) -> Column:
    """Whether either motion score misses its threshold; missing ones count as -1."""
    fails = (F.coalesce(mean, F.lit(-1.0)) < least_mean) | (F.coalesce(patch, F.lit(-1.0)) < least_patch)
    return fails & F.lit(not score_only)


def semantic_verdicts(clips: DataFrame, windows: DataFrame, key: str, answer: str, criteria: list[str], threshold: float, score_only: bool = False) -> DataFrame:
    """``clips`` with counts of windows, malformed and rejected ones, the issues found, and whether the clip passes.

    A window is rejected if any criterion is "yes". A clip fails if every window is malformed or the rejected share of
    all windows exceeds the threshold; one without windows fails too, with the error that tells so.
    """
    parsed = windows.select(key, tolerant_map(F.col(answer)).alias("m"))
    names = F.array(*(F.lit(c) for c in criteria))
    hits = F.filter(names, lambda c: F.coalesce(F.col("m")[F.replace(c, F.lit(" "), F.lit("_"))], F.lit("no")) == "yes")
    judged = parsed.select(key, F.col("m").isNull().alias("bad"), F.when(F.col("m").isNotNull(), hits).alias("hits"))
    sums = judged.groupBy(key).agg(F.count("*").alias("n_windows"), F.count_if("bad").alias("n_malformed"), F.count_if(F.size("hits") > 0).alias("n_rejected"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("hits")))).alias("issues"))
    out = clips.join(sums, key, "left")
    fails = F.col("n_windows").isNull() | (F.col("n_malformed") == F.col("n_windows")) | (F.col("n_rejected") / F.col("n_windows") > threshold)
    passes = ~fails if not score_only else F.lit(True)
    error = F.when(F.col("n_windows").isNull(), "all_windows_failed_preparation").when(F.col("n_malformed") > 0, "malformed_model_output")
    return out.withColumn("passes", passes).withColumn("error", error).fillna(0, ["n_windows", "n_malformed", "n_rejected"])


def classifier_verdicts(windows: DataFrame, key: str, answer: str, allow: list[str], block: list[str], labels: list[str], threshold: float, custom: bool = False) -> DataFrame:
    """For each key: whether allow and block rules pass, the labels found, the issues, and the counts behind them.

    Allowed: no allow list, or any window says "yes" to an allowed label, or there is nothing parsed and nothing
    malformed. Not blocked: the share of windows with a blocked label is at most the threshold. Only a window's first
    blocked label, in list order, is an issue. No label found is ``unclassified`` for custom lists.
    """
    m = F.col("m")
    said = lambda names: F.filter(F.array(*(F.lit(x) for x in names)) if names else F.array().cast("array<string>"), lambda x: F.coalesce(m[x], F.lit("no")) == "yes")
    parsed = windows.select(key, tolerant_map(F.col(answer)).alias("m"))
    each = parsed.select(key, m.isNull().alias("bad"), *(F.when(m.isNotNull(), said(names)).alias(c) for names, c in ((allow, "allowed"), (block, "blocked"), (labels, "found"))))
    sums = each.groupBy(key).agg(
        F.count("*").alias("n_windows"),
        F.count_if("bad").alias("n_malformed"),
        F.coalesce(F.bool_or(F.size("allowed") > 0), F.lit(False)).alias("any_allowed"),
        F.count_if(F.size("blocked") > 0).alias("n_rejected"),
        F.array_sort(F.collect_set(F.when(F.size("blocked") > 0, F.col("blocked")[0]))).alias("issues"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("found")))).alias("labels"),
    )
    allow_ok = F.lit(not allow) | F.col("any_allowed")
    block_ok = (F.col("n_rejected") / F.col("n_windows") <= threshold) if block else F.lit(True)
    named = F.when(F.size("labels") > 0, F.col("labels")).otherwise(F.array(F.lit("unclassified")) if custom else F.array().cast("array<string>"))
    return sums.withColumn("passes", allow_ok & block_ok).withColumn("labels", named).drop("any_allowed")


def routed_counts(rows: DataFrame, group: str) -> DataFrame:
    """Kept and rejected rows of each group, a column for each way out is left to the caller's pivot."""
    return rows.groupBy(group, F.coalesce(REJECTED, F.lit("kept")).alias("outcome")).agg(F.count("*").alias("n_rows"))
