"""Model-backed stages: what each asks of its kernel, what it prepares for it and what it makes of the answers.

A stage is relational on both sides of a kernel (:mod:`skein.operators.kernels`): ``prepare`` turns its rows into the
kernel's input, ``finish`` turns the kernel's columns into the stage's. Kernels are looked up by name in a registry that
anyone may add to, so a model family is a plug-in and a stage does not know it. A program is a list of steps from frame
to frame, chained by :func:`assembled`, which leaves out what a configuration switches off.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions import text
from skein.operators import frames, kernels, records, routing, shots, spans, tracks

Step = Callable[[DataFrame], DataFrame]


class Registry:
    """Kernel factories by family and name."""

    def __init__(self) -> None:
        self.factories: dict[tuple[str, str], Callable[..., kernels.Kernel]] = {}

    def add(self, family: str, name: str, factory: Callable[..., kernels.Kernel]) -> None:
        if (family, name) in self.factories:
            raise ValueError(f"{family}/{name} is registered already")
        self.factories[family, name] = factory

    def names(self, family: str) -> list[str]:
        return sorted(n for f, n in self.factories if f == family)

    def make(self, family: str, name: str, **options: Any) -> kernels.Kernel:
        if (family, name) not in self.factories:
            raise ValueError(f"no kernel {name!r} for {family!r}; there are {self.names(family)}")
        return self.factories[family, name](**options)


#: The registry that stages look kernels up in unless they are given another.
KERNELS = Registry()


@dataclass(frozen=True)
class Stage:
    """What a model-backed stage reads and asks its kernel for.

    ``inputs``: columns it needs. ``answer``: the kernel's output columns as DDL. ``prepare`` and ``finish`` take the frame
    and the stage's options.
    """

    name: str
    family: str
    inputs: tuple[str, ...]
    answer: str
    prepare: Callable[..., DataFrame] = lambda df, **_: df
    finish: Callable[..., DataFrame] = lambda df, **_: df
    options: dict[str, Any] = field(default_factory=dict)

    def __call__(self, df: DataFrame, kernel: str | kernels.Kernel, *, registry: Registry = KERNELS, batch_rows: int = 256, attempts: int = 1, **options: Any) -> DataFrame:
        """``df`` through the stage; a kernel's failure is an entry of ``errors`` under the stage's name."""
        if missing := set(self.inputs) - set(df.columns):
            raise ValueError(f"{self.name} needs {sorted(missing)}")
        unit = registry.make(self.family, kernel, **options.pop("kernel_options", {})) if isinstance(kernel, str) else kernel
        chosen = self.options | options
        made = kernels.with_kernel(self.prepare(df, **chosen), unit, batch_rows, attempts)
        if "errors" not in made.columns:
            made = made.withColumn("errors", F.create_map().cast("map<string,string>"))
        made = made.withColumn("errors", text.with_error(F.col("errors"), self.name, F.col("kernel_error"))).drop("kernel_error")
        return self.finish(made, **chosen)


def _scored(df: DataFrame, reduction: str = "min", **_) -> DataFrame:
    """One score of a clip's frames: their least, or their mean; none without scores."""
    n = F.nullif(F.size("scores"), F.lit(0))
    one = F.array_min("scores") if reduction == "min" else F.aggregate("scores", F.lit(0.0), lambda a, x: a + x) / n
    return df.withColumn("aesthetic_score", one).drop("scores")


def _cut_shots(df: DataFrame, threshold: float = 0.4, **_) -> DataFrame:
    """0/1 transitions of every frame from the windows' probabilities, in place of those."""
    flat = shots.middles(F.col("probabilities"), F.size("frames"))
    return df.withColumn("transitions", F.transform(flat, lambda p: (p > threshold).cast("int"))).drop("probabilities", "windows")


def _windows(df: DataFrame, frames_column: str = "num_frames", window: int = 256, remainder: int = 128, **_) -> DataFrame:
    """A row for each caption window of a clip; a clip without one keeps no row."""
    return df.select("*", F.posexplode(spans.caption_windows(F.col(frames_column), window, remainder)).alias("window_idx", "w")).select("*", F.col("w.start").alias("start_frame"), F.col("w.end").alias("end_frame")).drop("w")


def _prompted(df: DataFrame, prompt: str = "Describe the video.", **options) -> DataFrame:
    return _windows(df, **options).withColumn("prompt", F.lit(prompt))


def _captioned(df: DataFrame, variant: str = "default", **_) -> DataFrame:
    """Caption, status and token counts of each window from what the provider answered; only captions count as such."""
    status = text.caption_status(F.col("finish_reason"), F.col("answer"))
    good = status.isin(*records.CAPTIONED)
    return df.withColumn("status", status).withColumn("captions", F.when(good, F.create_map(F.lit(variant), F.col("answer"))).otherwise(F.create_map().cast("map<string,string>"))).drop("answer", "finish_reason")


def _per_variant(df: DataFrame, **_) -> DataFrame:
    """Each variant's caption under its own name."""
    return _captioned(df).withColumn("captions", F.when(F.size("captions") > 0, F.map_from_arrays(F.array("variant"), F.map_values("captions"))).otherwise(F.col("captions")))


def _first_caption(df: DataFrame, fields: tuple[str, ...] = ("default",), **_) -> DataFrame:
    """The distinct captions to encode: of a window the first field of the list that it has."""
    return df.select(text.first_present(F.col("captions"), list(fields)).alias("caption")).filter("caption is not null").distinct()


def encoded_captions(windows: DataFrame, key: str, kernel: str | kernels.Kernel, fields: list[str], *, registry: Registry = KERNELS) -> DataFrame:
    """(key, embeddings in window order, valid): each distinct caption encoded once; a window without one makes its clip invalid."""
    encoded = ENCODE_TEXT(windows, kernel, registry=registry, fields=tuple(fields)).select("caption", "encoded")
    own = windows.withColumn("caption", text.first_present(F.col("captions"), fields))
    joined = own.join(encoded, "caption", "left")
    return joined.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("encoded").isNotNull(), F.struct("window_idx", "encoded")))), lambda x: x["encoded"]).alias("embeddings"), F.bool_and(F.col("caption").isNotNull()).alias("valid"))


def _detected(df: DataFrame, rate: float = 8.0, **_) -> DataFrame:
    """One row for each tracked object of a clip, from the detections of its frames."""
    each = df.select("clip_uuid", F.inline("detections"))
    return frames.instances(each, "clip_uuid", "object_id", "frame", rate)


def _boxed(df: DataFrame, interval: int = 1, **_) -> DataFrame:
    """Tracks of overlay text and the share of frames with a corner box, as verdicts (n_tracks, corner_share_of) of each row."""
    made = df.withColumns({"n_tracks": tracks.n_tracks(F.col("boxes"), interval), "share": tracks.corner_share_of(F.col("boxes"), 1.0, 1.0)})
    return made.drop("boxes").fillna({"n_tracks": 0, "share": 0.0})


def _events(df: DataFrame, template: str = "{instances} {duration}", **_) -> DataFrame:
    return df.withColumn("prompt", text.event_prompt(template, F.col("instances"), F.col("seconds")))


def _parsed_events(df: DataFrame, **_) -> DataFrame:
    return df.withColumn("events", text.events_payload(F.col("answer"))).drop("answer")


def _needs_remux(df: DataFrame, containers: tuple[str, ...] = ("mp4",), **_) -> DataFrame:
    """Only rows whose container asks for it go through the kernel with their bytes."""
    return df.withColumn("input", F.when(~F.col("container").isin(*containers), F.col("content")))


def _remuxed(df: DataFrame, **_) -> DataFrame:
    return df.withColumn("was_remuxed", F.col("input").isNotNull() & F.col("output").isNotNull()).withColumn("content", F.coalesce("output", "content")).drop("input", "output")


def _planned(df: DataFrame, rate: float = 2.0, **_) -> DataFrame:
    """Which frames to decode for a grid, and how often each is wanted."""
    return df.withColumn("plan", frames.sampled(F.col("times"), rate))


def _at_rates(df: DataFrame, rates: tuple[int, ...] = (1, 2), **_) -> DataFrame:
    return df.withColumn("decode_rate", F.lit(frames.lcm_rate(list(rates))))


def _per_rate(df: DataFrame, rates: tuple[int, ...] = (1, 2), **_) -> DataFrame:
    """Frames at each asked rate, every k-th of those at the common one, by signature."""
    top = frames.lcm_rate(list(rates))
    each = [x for r in rates for x in (F.lit(f"{r}fps"), spans.every_kth(F.col("frames"), top // r))]
    return df.withColumn("frames_by_rate", F.create_map(*each)).drop("frames", "decode_rate")


def _ranged(df: DataFrame, **_) -> DataFrame:
    return df.withColumn("windows", shots.batch_ranges(F.size("frames")))


BYTES = "output binary"
ANSWER = "answer string, finish_reason string, prompt_tokens bigint, output_tokens bigint"

DECODE_SMALL = Stage("frame_decode", "decoder", ("content",), "frames array<int>")
DETECT_SHOTS = Stage("shot_detector", "shots", ("frames",), "probabilities array<array<double>>", _ranged, _cut_shots)
TRANSCODE = Stage("transcode", "codec", ("content", "span"), BYTES)
REMUX = Stage("remux", "codec", ("content", "container"), BYTES, _needs_remux, _remuxed)
CLIP_FRAMES = Stage("clip_frames", "decoder", ("content",), "frames array<int>", _at_rates, _per_rate)
AESTHETIC = Stage("aesthetic", "scorer", ("content",), "scores array<double>", finish=_scored)
OVERLAY_TEXT = Stage("overlay_text", "ocr", ("clip_uuid", "content"), "boxes array<struct<frame:bigint,x0:double,y0:double,x1:double,y1:double>>", finish=_boxed)
EMBED_CLIP = Stage("clip_embedding", "embedder", ("content",), "embedding array<float>")
EMBED_IMAGE = Stage("image_embedding", "embedder", ("content",), "embedding array<float>", finish=lambda df, model="default", **_: df.withColumn("embeddings", F.create_map(F.lit(model), F.col("embedding"))).drop("embedding"))
CAPTION = Stage("caption", "captioner", ("num_frames",), ANSWER, _prompted, _captioned)
ENHANCE = Stage("enhance_caption", "chat", ("caption",), "enhanced string")
ENCODE_TEXT = Stage("text_encoder", "text", ("captions",), "encoded array<float>", _first_caption)
EVENT_CAPTIONS = Stage("event_captions", "captioner", ("instances", "seconds"), "answer string", _events, _parsed_events)
TRACK_OBJECTS = Stage("object_tracking", "tracker", ("clip_uuid", "content"), "detections array<struct<frame:bigint,object_id:bigint>>", finish=_detected)
PREVIEW = Stage("preview", "codec", ("content",), BYTES)
SUPER_RESOLUTION = Stage("super_resolution", "codec", ("content",), BYTES)
CAPTION_IMAGE = Stage("image_caption", "captioner", ("content",), ANSWER, lambda df, prompt="Describe the image.", **_: df.withColumn("prompt", F.lit(prompt)), _captioned)
CAPTION_CAMERA = Stage("camera_caption", "captioner", ("num_frames",), ANSWER, lambda df, variants=("default",), **o: _prompted(df, **o).withColumn("variant", F.explode(F.array(*(F.lit(v) for v in variants)))), _per_variant)
SPLIT_WINDOWS = Stage("window_split", "decoder", ("num_frames",), "frames array<int>", _windows)
DECODE_EXACT = Stage("exact_decode", "decoder", ("times",), "frames array<int>", _planned)
GENERATE_TEXT = Stage("text_generation", "chat", ("prompt",), "generated string")

#: All stages by name.
STAGES: dict[str, Stage] = {s.name: s for s in list(globals().values()) if isinstance(s, Stage)}


def rejected_by_score(df: DataFrame, threshold: float) -> DataFrame:
    """Clips whose aesthetic score is missing or below the threshold, rejected as such."""
    return routing.reject(df, routing.aesthetic(F.when(F.col("aesthetic_score").isNotNull(), F.array("aesthetic_score")), threshold), "aesthetic")


@dataclass(frozen=True)
class Named:
    """A step of a program under its name; ``on`` False leaves it out."""

    name: str
    step: Step
    on: bool = True


def assembled(steps: list[Named], observed: bool = False) -> Step:
    """One function of all steps that are on; two of one name are an error.

    With ``observed`` each step's rows are counted as Spark observes them (``spark.sql`` listeners get ``rows`` under the
    step's name), without a pass of their own.
    """
    on = [s for s in steps if s.on]
    if len({s.name for s in on}) < len(on):
        raise ValueError("two steps have one name")

    def run(df: DataFrame) -> DataFrame:
        for s in on:
            df = df.transform(s.step)
            if observed:
                df = df.observe(s.name, F.count(F.lit(1)).alias("rows"))
        return df

    return run


def models_of(steps: list[Named]) -> list[str]:
    """Sorted names of the kernels that the steps' functions declare in an attribute ``models``."""
    return sorted({m for s in steps if s.on for m in getattr(s.step, "models", ())})


def using(stage: Stage, kernel: str, **options: Any) -> Step:
    """A step that runs a stage with a registered kernel and declares it."""

    def step(df: DataFrame) -> DataFrame:
        return stage(df, kernel, **options)

    step.models = (kernel,)
    return step

