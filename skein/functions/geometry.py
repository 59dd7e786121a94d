"""Sizes, bins and boxes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper ends of the aspect-ratio bins (width by height, lower end open) and their names.
ASPECT_BINS = ((0.65, "9:16"), (0.88, "3:4"), (1.16, "1:1"), (1.55, "4:3"), (10.0, "16:9"))
# Least shorter side of each resolution class.
RESOLUTIONS = ((1080, "1080"), (720, "720"))
LOW_RESOLUTION = "lt_720"
# Duration bins in seconds, both ends inclusive; the first that fits counts.
DURATIONS = ((5.0, 10.0, "5_10"), (10.0, 30.0, "10_30"), (30.0, float("inf"), "30_inf"))
# The largest aspect ratio that a resize takes, and the frame counts of a model input.
MAX_RATIO = 200
FRAME_FACTOR, MIN_FRAMES, MAX_FRAMES = 2, 4, 768


def aspect_bin(width: Column, height: Column) -> Column:
    """Name of the aspect bin; null for a ratio of 0 or less, or above the last bin."""
    ratio = width.cast("double") / F.nullif(height.cast("double"), F.lit(0.0))
    out = F.when(ratio <= 0, F.lit(None).cast("string"))
    for top, name in ASPECT_BINS:
        out = out.when(ratio <= top, name)
    return out


def resolution_bin(width: Column, height: Column) -> Column:
    short = F.least(width, height)
    out = None
    for least, name in RESOLUTIONS:
        out = F.when(short >= least, name) if out is None else out.when(short >= least, name)
    return out.otherwise(LOW_RESOLUTION)


def duration_bin(seconds: Column) -> Column:
    out = None
    for lo, hi, name in DURATIONS:
        fits = (seconds >= lo) & (seconds <= F.lit(hi))
        out = F.when(fits, name) if out is None else out.when(fits, name)
    return out


def video_bin(width: Column, height: Column, frames: Column, framerate: Column) -> Column:
    """aspect/resolution/duration path of a clip; null where any has no bin or the frame rate is not positive."""
    seconds = frames / F.nullif(F.greatest(framerate.cast("double"), F.lit(0.0)), F.lit(0.0))
    parts = (aspect_bin(width, height), resolution_bin(width, height), duration_bin(seconds))
    return F.when(parts[0].isNotNull() & parts[2].isNotNull(), F.concat_ws("/", F.replace(parts[0], F.lit(":"), F.lit("_")), parts[1], parts[2]))


def even(n: Column) -> Column:
    """The nearest even integer; of two the upper one."""
    return (2 * F.floor((n + 1) / 2)).cast("long")


def resized_by_shorter(width: Column, height: Column, short: int) -> Column:
    """struct(width, height) scaled so that the shorter side is ``short``, the longer one even."""
    long_w = even(F.bround(F.lit(short) / height * width))
    long_h = even(F.bround(F.lit(short) / width * height))
    return F.when(height < width, F.struct(long_w.alias("width"), F.lit(short).cast("long").alias("height"))).otherwise(F.struct(F.lit(short).cast("long").alias("width"), long_h.alias("height")))


def smart_resize(width: Column, height: Column, factor: int, min_pixels: int, max_pixels: int) -> Column:
    """struct(height, width) divisible by ``factor`` and within the pixel bounds, ratio kept; error for extreme ratios."""
    w, h = width.cast("double"), height.cast("double")
    near = lambda x: F.greatest(F.lit(factor), F.bround(x / factor) * factor)
    area = near(h) * near(w)
    shrink, grow = F.sqrt(h * w / max_pixels), F.sqrt(F.lit(min_pixels) / (h * w))
    side = lambda x: F.when(area > max_pixels, F.floor(x / shrink / factor) * factor).when(area < min_pixels, F.ceil(x * grow / factor) * factor).otherwise(near(x)).cast("long")
    good = F.greatest(w, h) / F.least(w, h) <= MAX_RATIO
    return F.when(good, F.struct(side(h).alias("height"), side(w).alias("width"))).otherwise(F.raise_error(F.lit("aspect ratio out of range")))


def sampled_frames(fps: float, total: Column, video_fps: Column) -> Column:
    """Number of frames to sample, even and within bounds."""
    most = F.floor(F.least(F.lit(MAX_FRAMES), total) / FRAME_FACTOR) * FRAME_FACTOR
    wanted = F.least(F.greatest(total / video_fps * fps, F.lit(float(MIN_FRAMES))), most)
    return (F.bround(wanted / FRAME_FACTOR) * FRAME_FACTOR).cast("long")


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of boxes struct(x0, y0, x1, y1); 0 where the union is empty."""
    w = F.greatest(F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]), F.lit(0.0))
    h = F.greatest(F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]), F.lit(0.0))
    size = lambda r: (r["x1"] - r["x0"]) * (r["y1"] - r["y0"])
    union = size(a) + size(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(F.lit(0.0))


def in_corner(box: Column, width: Column, height: Column, x_share: float, y_share: float) -> Column:
    """Whether a box lies in one of the four corner zones, sized by shares of the frame."""
    x = (box["x1"] <= width * x_share) | (box["x0"] >= width * (1 - x_share))
    y = (box["y1"] <= height * y_share) | (box["y0"] >= height * (1 - y_share))
    return x & y
