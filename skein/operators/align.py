"""Time alignment: sampling grids and windows, nearest and governing samples, several sensors on one grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def grid(start: Column, end: Column, step: int, inclusive: bool = True) -> Column:
    """Grid points from start, a step apart; integers of any one unit."""
    last = end if inclusive else end - 1
    return F.when(start <= last, F.sequence(start, last, F.lit(step).cast("long"))).otherwise(F.array().cast("array<long>"))


def windows(start: Column, end: Column, duration: int, stride: int) -> Column:
    """Half-open windows (index, start, end) from the start on, the last ones cut at the end; a zero-length range is one."""
    begins = F.when(start < end, F.sequence(start, end - 1, F.lit(stride).cast("long"))).when(start == end, F.array(start)).otherwise(F.array().cast("array<long>"))
    return F.transform(begins, lambda s, i: F.struct(i.cast("long").alias("idx"), s.alias("start"), F.least(s + duration, end).alias("end")))


def nearest(samples: DataFrame, points: DataFrame, key: str, sample_time: str, point_time: str) -> DataFrame:
    """(key, point_time, nearest sample_time) for each point; of two equally near the earlier. Keys without samples go.

    One sort of samples and points together instead of an as-of join: the last sample at or before each point and the
    first after it are carried along the order. Both frames grow from one end, so the work is linear in a key's rows;
    the second order is the first one backwards.
    """
    both = samples.select(key, F.col(sample_time).alias("t"), F.col(sample_time).alias("s"), F.lit(0).alias("kind")).unionByName(points.select(key, F.col(point_time).alias("t"), F.lit(None).cast("long").alias("s"), F.lit(1).alias("kind")))
    order = W.partitionBy(key).orderBy("t", "kind")
    before = F.last("s", True).over(order.rowsBetween(W.unboundedPreceding, 0))
    after = F.last("s", True).over(W.partitionBy(key).orderBy(F.desc("t"), F.desc("kind")).rowsBetween(W.unboundedPreceding, 0))
    out = both.withColumn("b", before).withColumn("a", after).filter("kind = 1")
    near = F.when(F.col("b").isNull(), F.col("a")).when(F.col("a").isNull(), F.col("b")).when(F.col("a") - F.col("t") < F.col("t") - F.col("b"), F.col("a")).otherwise(F.col("b"))
    return out.select(key, F.col("t").alias(point_time), near.alias(sample_time)).filter(F.col(sample_time).isNotNull())


def placed(samples: DataFrame, spans: DataFrame, key: str, time: str = "t") -> DataFrame:
    """Each sample with every span (key, idx, start, end) that it is in.

    A range join by buckets of time: a bucket is as long as the longest span, so a span is in two buckets at most and a
    sample meets only the spans of its own.
    """
    width = F.greatest(F.max(F.col("end") - F.col("start")), F.lit(1)).alias("width")
    own = F.floor(F.col(time) / F.col("width"))
    widths = spans.groupBy(key).agg(width)
    first, last = F.floor(F.col("start") / F.col("width")), F.floor((F.greatest(F.col("end") - 1, F.col("start"))) / F.col("width"))
    laid = spans.join(widths, key).withColumn("bucket", F.explode(F.sequence(first, last))).drop("width")
    dealt = samples.join(widths, key).withColumn("bucket", own).drop("width")
    return dealt.join(laid, [key, "bucket"]).filter((F.col(time) >= F.col("start")) & (F.col(time) < F.col("end"))).drop("bucket")


def window_samples(samples: DataFrame, spans: DataFrame, points: DataFrame, key: str, tolerance: int | None = None) -> DataFrame:
    """(key, idx, t, n): in each window the samples nearest to its points and how many points each has.

    ``samples``: key, t. ``spans``: key, idx, start, end. ``points``: key, idx, p (each window's own points).
    Samples count from the window's first point to its end; windows without samples or points have no rows. A distance
    over the tolerance is an error that names the pair.
    """
    first = points.groupBy(key, "idx").agg(F.min("p").alias("first"))
    bounds = spans.join(first, [key, "idx"])
    inside = placed(samples, bounds, key).filter(F.col("t") >= F.col("first")).select(F.struct(key, "idx").alias("k"), "t")
    near = nearest(inside, points.select(F.struct(key, "idx").alias("k"), "p"), "k", "t", "p")
    if tolerance is not None:
        far = F.abs(F.col("t") - F.col("p")) > tolerance
        message = F.concat(F.lit("tolerance exceeded: point "), F.col("p").cast("string"), F.lit(", sample "), F.col("t").cast("string"))
        near = near.withColumn("t", F.when(far, F.raise_error(message).cast("long")).otherwise(F.col("t")))
    return near.groupBy("k", "t").agg(F.count("*").alias("n")).select(f"k.{key}", "k.idx", "t", "n")


def aligned(spans: DataFrame, readings: DataFrame, key: str, sensor: str, value: str) -> DataFrame:
    """One row for each window with a map from sensor to its sorted readings; absent sensors are left out of the map."""
    found = placed(readings, spans, key).groupBy(key, "idx", sensor).agg(F.array_sort(F.collect_list(F.struct("t", value))).alias("r"))
    maps = found.groupBy(key, "idx").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(sensor, "r")))).alias("frames"))
    return spans.join(maps, [key, "idx"], "left").withColumn("frames", F.coalesce("frames", F.map_from_arrays(F.array().cast(f"array<{dict(readings.dtypes)[sensor]}>"), F.array().cast(dict(found.groupBy().agg(F.collect_list('r').alias('x')).dtypes)["x"]))))


def governing_key_frame(frames: DataFrame, key: str, order: list[str], is_key: str, frame: str) -> DataFrame:
    """``frames`` with the last key frame at or before each; frames before the first one take the first."""
    w = W.partitionBy(key).orderBy(*order)
    mark = F.when(F.col(is_key), F.col(frame))
    back = F.last(mark, True).over(w.rowsBetween(W.unboundedPreceding, 0))
    first = F.first(mark, True).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return frames.withColumn("key_frame", F.coalesce(back, first))


def nearest_in_array(times: Column, target: Column) -> Column:
    """Index of the nearest of a sorted array; the first on ties; null for an empty array."""
    return F.array_min(F.transform(times, lambda t, i: F.struct(F.abs(t - target).alias("d"), i.alias("i"))))["i"]


def pts_to_ns(pts: Column, numerator: int, denominator: int) -> Column:
    """Time of a stamp in nanoseconds, exactly and rounded down, negative stamps too."""
    n = pts.cast("decimal(20,0)") * F.lit(numerator).cast("decimal(9,0)") * F.lit(10**9).cast("decimal(10,0)")
    rest = F.pmod(n, F.lit(denominator).cast("decimal(38,0)"))
    return ((n - rest) / F.lit(denominator).cast("decimal(10,0)")).cast("decimal(38,0)").cast("long")
