"""Batches of frames for a shot detector: overlapping windows whose middles tile the recording, and what comes back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Frames of a window, frames that it is ahead of the one before, and frames before its middle.
WINDOW, HOP, LEAD = 100, 50, 25


def batch_ranges(total: Column) -> Column:
    """array<struct<idx, start, end, front>> of the windows over ``total`` frames, ends exclusive.

    A window is 100 frames from 25 before its middle of 50 on. ``front`` copies of the first frame stand in for frames
    before the first; at the end a window is as short as the recording leaves it.
    """
    n = F.ceil(total / HOP).cast("int")
    made = F.transform(
        F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1),
        lambda i: F.struct(
            i.cast("long").alias("idx"),
            F.greatest(i * HOP - LEAD, F.lit(0)).cast("long").alias("start"),
            F.least(i * HOP + WINDOW - LEAD, total).cast("long").alias("end"),
            F.greatest(F.lit(LEAD) - i * HOP, F.lit(0)).cast("long").alias("front"),
        ),
    )
    return F.when(total > 0, made).otherwise(F.array().cast("array<struct<idx:long,start:long,end:long,front:long>>"))


def batches(frames: Column) -> Column:
    """The windows of :func:`batch_ranges` filled with frames."""
    cut = lambda b: F.slice(frames, b["start"] + 1, b["end"] - b["start"])
    return F.transform(batch_ranges(F.size(frames)), lambda b: F.concat(F.array_repeat(F.get(frames, F.lit(0)), b["front"].cast("int")), cut(b)))


def middles(predictions: Column, total: Column) -> Column:
    """One array of all frames' predictions: the middle 50 of each window's, one after the other, cut to ``total``."""
    return F.slice(F.flatten(F.transform(predictions, lambda p: F.slice(p, LEAD + 1, HOP))), F.lit(1), F.greatest(total, F.lit(0)))
