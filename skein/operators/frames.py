"""Frames and clips of several cameras: regularity checks, aligned strides, chunking by seconds, sampling at a rate."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skein.operators.grouping import closed_on_reach

# Bounds of frame gaps and of a clip's time, as shares of the nominal.
GAP_LOW, GAP_HIGH = 0.5, 2.0
CLIP_LOW, CLIP_HIGH = 0.95, 1.05
SECONDS_PER_CLIP = 8


def regular(times: Column, framerate: Column, clip_ms: Column, clip_seconds: Column) -> Column:
    """Whether frame gaps (ms) and the clip's time are near the nominal ones; false without a frame rate or gaps."""
    n = F.size(times)
    gaps = F.zip_with(F.slice(times, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(times, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: b - a)
    nominal = 1000.0 / framerate
    fits = (F.array_max(gaps) <= nominal * GAP_HIGH) & (F.array_min(gaps) >= nominal * GAP_LOW)
    whole = (clip_ms <= clip_seconds * 1000 * CLIP_HIGH) & (clip_ms >= clip_seconds * 1000 * CLIP_LOW)
    return F.coalesce((n > 1) & fits & whole, F.lit(False))


def aligned_strides(cameras: DataFrame, session: str, camera: str, times: str, framerate: str, length: int, stride: int, limit: int = 0, verify: bool = True) -> DataFrame:
    """(session, idx, camera, first, last) of clips of ``length`` frames that every camera of a session has.

    ``cameras``: one row for each camera with its frame times (sorted, ms) and frame rate. Clip idx starts idx strides
    (in the last camera's frames) after the earliest first frame; each camera takes its nearest frame, the first on
    ties. A session ends at the first index where a camera has no frame left or the clip would pass its last frame;
    ``limit`` counts indices. With ``verify`` an index is left out, and still counted, unless all cameras are regular.
    """
    t = F.col(times)
    ends = cameras.groupBy(session).agg(F.min(t[0]).alias("__start"), F.min(F.element_at(t, -1)).alias("__end"), (F.max_by(F.lit(stride) / F.col(framerate), camera) * 1000).alias("__step"))
    n = F.ceil((F.col("__end") - F.col("__start")) / F.col("__step")).cast("int")
    steps = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    starts = ends.select(session, "__start", "__step", F.explode(F.slice(steps, 1, limit) if limit else steps).alias("idx"))
    at = F.col("__start") + F.col("idx") * F.col("__step")
    near = F.array_min(F.transform(t, lambda x, i: F.struct(F.abs(x - F.col("__at")).alias("d"), i.alias("i"))))["i"]
    found = cameras.join(starts, session).withColumn("__at", at).withColumn("first", near).withColumn("last", F.col("first") + length)
    there = (F.col("__at") < F.element_at(t, -1)) & (F.col("last") < F.size(t))
    clip_ms = F.get(t, F.col("last")) - F.get(t, F.col("first"))
    even = regular(F.slice(t, F.col("first") + 1, F.lit(length)), F.col(framerate), clip_ms, F.lit(length) / F.col(framerate)) if verify else F.lit(True)
    found = found.withColumn("__there", F.coalesce(there, F.lit(False))).withColumn("__even", even)
    each = found.groupBy(session, "idx").agg(F.bool_and("__there").alias("__there"), F.bool_and("__even").alias("__even"))
    cut = each.groupBy(session).agg(F.min(F.when(~F.col("__there"), F.col("idx"))).alias("__stop"))
    good = each.join(cut, session).filter(F.col("__even") & (F.col("__stop").isNull() | (F.col("idx") < F.col("__stop")))).select(session, "idx")
    return found.join(good, [session, "idx"]).select(session, F.col("idx").cast("long").alias("idx"), camera, F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"))


def chunked_by_seconds(clips: DataFrame, session: str, camera_rank: str, index: str, start: str, end: str, clips_per_chunk: int) -> DataFrame:
    """``clips`` with ``chunk_index`` and ``n_chunks``: the primary camera's clips weighed by whole seconds, a chunk
    closes at 8 seconds a clip asked for, and the other cameras are cut at the same indices."""
    own = clips.filter(F.col(camera_rank) == 0).select(session, index, F.floor(F.col(end) - F.col(start)).cast("long").alias("__s"))
    cut = closed_on_reach(own, session, [index], "__s", clips_per_chunk * SECONDS_PER_CLIP).select(session, index, F.col("group_no").alias("chunk_index"))
    n = cut.groupBy(session).agg((F.max("chunk_index") + 1).alias("n_chunks"))
    return clips.join(cut.join(n, session), [session, index])


def chunked_by_count(rows: DataFrame, key: str, order: list[str], size: int) -> DataFrame:
    """``rows`` with a chunk number of ``size`` rows each, in order within the key."""
    return rows.withColumn("chunk_index", F.floor((F.row_number().over(W.partitionBy(key).orderBy(*order)) - 1) / size).cast("long"))


def common_span(cameras: DataFrame, session: str, start: str, seconds: str) -> DataFrame:
    """(session, start, end): from 0 to the least end less the greatest start of the cameras."""
    return cameras.groupBy(session).agg(F.max(start).alias("__s"), F.min(F.col(start) + F.col(seconds)).alias("__e")).select(session, F.lit(0.0).alias("start"), (F.col("__e") - F.col("__s")).alias("end"))


def sampled(times: Column, rate: float, endpoint: bool = True) -> Column:
    """Array of (index, n) of the frames nearest to a grid at ``rate`` per second, distinct; ties take the earlier.

    The grid starts at the first frame; with ``endpoint`` the last may be half an interval past the last frame.
    """
    step = 1.0 / rate
    first, last = F.get(times, F.lit(0)), F.element_at(times, -1)
    span = last - first + (step * 0.5 if endpoint else 0.0)
    n = F.ceil(span / step).cast("int")
    points = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: first + i * F.lit(step))
    near = F.transform(points, lambda p: F.array_min(F.transform(times, lambda t, i: F.struct(F.abs(t - p).alias("d"), i.alias("i"))))["i"])
    counted = F.transform(F.array_sort(F.array_distinct(near)), lambda i: F.struct(i.alias("idx"), F.size(F.filter(near, lambda x: x == i)).alias("n")))
    return F.when(F.size(times) > 0, counted)


def lcm_rate(rates: list[float]) -> int:
    """The least rate of which all given ones are whole parts."""
    return math.lcm(*(int(r) for r in rates))


def pairwise(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """(key, value, next) of neighbouring rows."""
    following = F.lead(value).over(W.partitionBy(key).orderBy(order))
    return rows.withColumn("next", following).filter(F.col("next").isNotNull()).select(key, value, "next")


def instances(detections: DataFrame, clip: str, obj: str, frame: str, rate: float) -> DataFrame:
    """One row for each tracked object of a clip: first and last second and frames, by start, then object."""
    seconds = F.col(frame) / rate
    return detections.groupBy(clip, obj).agg(F.min(seconds).alias("start_time_s"), F.max(seconds).alias("end_time_s"), F.count("*").alias("num_frames"))


def small_motion(vectors: Column, least_mean: float, least_patch: float) -> Column:
    """struct(mean, patch, small) of per-cell mean magnitudes: their mean, their least, and whether either is too small."""
    mean = F.aggregate(vectors, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(vectors), F.lit(0))
    patch = F.array_min(vectors)
    return F.struct(mean.alias("mean"), patch.alias("patch"), ((mean < least_mean) | (patch < least_patch)).alias("small"))


def weight(seconds: Column, clips: Column, total: Column) -> Column:
    """Weight of a recording's task: five minutes are 1, scaled by the share of its clips that are present."""
    return seconds / 300 * F.coalesce(clips / F.nullif(total, F.lit(0)), F.lit(1.0))


def scattered(clips: DataFrame, answers: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``clips`` with the answer of equal keys; an answer without its place, or a place without one, is an error."""
    both = clips.join(answers.select(*keys, F.col(value), F.lit(True).alias("__has")), keys, "full_outer")
    known = both.withColumn("__has", F.coalesce("__has", F.lit(False)))
    return known.withColumn(value, F.when(F.col("__has"), F.col(value)).otherwise(F.raise_error(F.lit("a window has no answer")).cast(dict(answers.dtypes)[value]))).drop("__has")
