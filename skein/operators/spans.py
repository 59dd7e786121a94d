"""Cutting recordings: strides, scenes, caption windows, frame grids. All native expressions, no shuffle of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def fixed_stride(start: Column, end: Column, length: float, stride: float, min_length: float, limit: int = 0) -> Column:
    """Spans of ``length`` every ``stride`` as array<struct<start,end>>; the last ones are cut at the end.

    A span is kept from ``min_length`` on; ``limit`` keeps the first ones only. Null or empty recordings have none.
    """
    n = F.ceil((end - start) / stride).cast("int")
    steps = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    made = F.transform(steps, lambda i: F.struct((start + i * F.lit(stride)).alias("start"), F.least(start + i * F.lit(stride) + length, end).alias("end")))
    kept = F.filter(made, lambda s: s["end"] - s["start"] >= min_length)
    return F.slice(kept, 1, limit) if limit else kept


def caption_windows(total: Column, size: int, threshold: int) -> Column:
    """Windows of ``size`` frames with inclusive ends: none below four frames; a remainder of ``threshold`` frames is a
    window of its own, a smaller one lengthens the last."""
    full, rest = F.floor(total / size).cast("int"), (total % size).cast("int")
    ends = lambda i: F.when((i == full - 1) & (rest < threshold), total - 1).otherwise((i + 1) * size - 1)
    whole = F.transform(F.sequence(F.lit(0), F.greatest(full, F.lit(1)) - 1), lambda i: F.struct((i * size).cast("long").alias("start"), ends(i).cast("long").alias("end")))
    tail = F.array(F.struct((full * size).cast("long").alias("start"), (total - 1).cast("long").alias("end")))
    one = F.array(F.struct(F.lit(0).cast("long").alias("start"), (total - 1).cast("long").alias("end")))
    none = F.array().cast("array<struct<start:long,end:long>>")
    return F.when(total.isNull() | (total < 4), none).when(total <= size, one).when(rest >= threshold, F.when(rest > 0, F.concat(whole, tail)).otherwise(whole)).otherwise(whole)


def frame_time(frame: Column, frames: Column, duration: Column) -> Column:
    """Source time of a frame by linear interpolation; a single frame counts as two."""
    return frame / F.greatest(frames - 1, F.lit(1)) * duration


def scenes(frames: DataFrame, key: str, order: list[str], flag: str, whole: bool = False) -> DataFrame:
    """(key, start, end) of shots from a 0/1 transition flag for each frame.

    A shot opens where the flag falls and closes where it rises (not on the first frame); an open one at the end is
    kept if a shot was found before it. With ``whole`` a recording without shots is one from 0 to its length.
    """
    w = W.partitionBy(key).orderBy(*order)
    numbered = frames.select(key, (F.row_number().over(w) - 1).alias("i"), F.col(flag).cast("int").alias("t"), F.lag(F.col(flag).cast("int"), 1, 0).over(w).alias("before"), F.count("*").over(W.partitionBy(key)).alias("n"))
    run = W.partitionBy(key).orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    opened = F.coalesce(F.max(F.when((F.col("before") == 1) & (F.col("t") == 0), F.col("i"))).over(run), F.lit(0))
    marked = numbered.withColumn("start", opened).withColumn("closes", (F.col("before") == 0) & (F.col("t") == 1) & (F.col("i") > 0))
    marked = marked.withColumn("found", F.sum(F.col("closes").cast("int")).over(W.partitionBy(key)))
    closed = F.col("closes")
    trailing = (F.col("i") == F.col("n") - 1) & (F.col("t") == 0) & (F.col("found") > 0)
    out = marked.filter(closed | trailing).select(key, F.col("start").cast("long").alias("start"), F.col("i").cast("long").alias("end"))
    if whole:
        out = out.unionByName(marked.filter((F.col("found") == 0) & (F.col("i") == 0)).select(key, F.lit(0).cast("long").alias("start"), F.col("n").cast("long").alias("end")))
    return out


def filtered_scenes(shots: DataFrame, min_length: int | None = None, max_length: int | None = None, mode: str = "truncate", crop: int | None = None) -> DataFrame:
    """Shots cut at ``max_length`` (or split into such: mode "stride"), cropped at both ends, of ``min_length`` or more."""
    out = shots
    if max_length is not None and mode == "truncate":
        out = out.withColumn("end", F.least(F.col("start") + max_length, F.col("end")))
    elif max_length is not None:
        steps = F.sequence(F.col("start"), F.col("end") - 1, F.lit(max_length).cast("long"))
        out = out.filter("end > start").withColumn("s", F.explode(steps)).withColumn("e", F.least(F.col("s") + max_length, F.col("end")))
        if min_length:
            out = out.filter((F.col("e") - F.col("s") >= min_length) | (F.col("e") != F.col("end")))
        out = out.withColumn("start", F.col("s")).withColumn("end", F.col("e")).drop("s", "e")
    if crop is not None:
        out = out.withColumn("start", F.col("start") + crop).withColumn("end", F.col("end") - crop).filter("end > start")
    return out if min_length is None else out.filter(F.col("end") - F.col("start") >= min_length)


def every_kth(frames: Column, k: int) -> Column:
    return F.filter(frames, lambda _, i: i % k == 0)


def middle_frame(frames: Column) -> Column:
    """The middle element; of an even number the earlier one."""
    n = F.size(frames)
    return F.when(n > 0, F.get(frames, F.floor((n - 1) / 2).cast("int")))


def batched(items: Column, size: int) -> Column:
    """An array cut into batches of ``size`` items, the last one as long as what is left."""
    n = F.ceil(F.size(items) / size).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.slice(items, i * size + 1, F.lit(size)))
    return F.when(n > 0, cut).otherwise(F.filter(F.array(items), lambda x: F.lit(False)))
