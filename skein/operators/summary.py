"""Roll-ups: clips by source, captions by document, stage counters, sessions, completion at three levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clip_stats(clips: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Clips, seconds and the longest clip of each key."""
    long = F.col(end) - F.col(start)
    return clips.groupBy(key).agg(F.count("*").alias("n_clips"), F.round(F.sum(long), 4).alias("total_s"), F.round(F.max(long), 4).alias("max_s"))


def split_summary(inputs: DataFrame, chunks: DataFrame, key: str, sums: list[str], greatest: list[str]) -> DataFrame:
    """Every input with the sums over its chunks and whether it was processed; inputs without chunks have zeros."""
    made = chunks.groupBy(key).agg(*(F.sum(c).alias(c) for c in sums), *(F.max(c).alias(c) for c in greatest), F.lit(True).alias("processed"))
    return inputs.join(made, key, "left").fillna(0, [*sums, *greatest]).fillna(False, ["processed"])


def captions_document(windows: DataFrame, video: str, clip: str, window: str, text: str, version: str) -> DataFrame:
    """video -> clip -> window -> text as nested maps; of several texts of a window the latest counts."""
    last = windows.groupBy(video, clip, window).agg(F.max_by(text, version).alias("t"))
    inner = last.groupBy(video, clip).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(window).cast("string"), "t")))).alias("m"))
    return inner.groupBy(video).agg(F.map_from_entries(F.collect_list(F.struct(F.col(clip).cast("string"), "m"))).alias("captions"))


def caption_chain(windows: DataFrame, keys: list[str], order: str, text: str, kind: str) -> DataFrame:
    """Rows of a caption chain, newest first: ``kind`` for the newest, ``kind_000``, ``kind_001``... for the older."""
    chains = windows.groupBy(*keys).agg(F.reverse(F.array_sort(F.collect_list(F.struct(order, text)))).alias("c"))
    each = chains.select(*keys, F.posexplode("c").alias("i", "x"))
    name = F.when(F.col("i") == 0, F.lit(kind)).otherwise(F.concat(F.lit(f"{kind}_"), F.lpad((F.col("i") - 1).cast("string"), 3, "0")))
    return each.select(*keys, F.col(f"x.{text}").alias(text), name.alias("prompt_type"))


def even_chains(windows: DataFrame, clip: str, window: str) -> DataFrame:
    """Clips whose windows all have chains of one length."""
    sizes = windows.groupBy(clip, window).agg(F.count("*").alias("n"))
    return sizes.groupBy(clip).agg(F.min("n").alias("lo"), F.max("n").alias("hi")).filter("lo = hi").select(clip, F.col("hi").alias("chain"))


def stage_counters(rows: DataFrame, stages: str) -> DataFrame:
    """Sums of a map from stage to counter over all rows: the union of the stages."""
    return rows.select(F.explode(stages).alias("stage", "n")).groupBy("stage").agg(F.sum("n").alias("total"))


def session_clips(chunks: DataFrame, session: str, index: str, clips: str, duration: str) -> DataFrame:
    """Clips of each session in chunk order; the duration is that of chunk 0."""
    packed = chunks.groupBy(session).agg(F.array_sort(F.collect_list(F.struct(index, clips))).alias("c"), F.max(F.when(F.col(index) == 0, F.col(duration))).alias(duration))
    return packed.select(session, F.flatten(F.col("c")[clips]).alias(clips), duration)


def completion(items: DataFrame, root: str, folder: str, done: str) -> DataFrame:
    """Inputs, outputs, what is left and percent, for each folder, each root and in total.

    Without inputs the percentage is 0 for a folder and NaN above.
    """
    level = F.when(F.grouping(folder) == 0, "folder").when(F.grouping(root) == 0, "root").otherwise("total")
    sums = items.rollup(root, folder).agg(level.alias("level"), F.count("*").alias("inputs"), F.count_if(done).alias("outputs"))
    share = F.when(F.col("inputs") > 0, 100.0 * F.col("outputs") / F.col("inputs")).when(F.col("level") == "folder", 0.0).otherwise(float("nan"))
    return sums.withColumn("left_over", F.col("inputs") - F.col("outputs")).withColumn("percent", F.round(share, 4))


def outcome_lists(items: DataFrame, key: str, passed: str) -> DataFrame:
    """Counts of all, passed and rejected items and the sorted ids of the rejected ones by group of their hash.

    A list of all ids would be one row of unbounded size; 256 groups keep each a small share.
    """
    return items.groupBy(F.pmod(F.xxhash64(key), F.lit(256)).alias("slice")).agg(F.count("*").alias("n"), F.count_if(passed).alias("n_passed"), F.array_sort(F.collect_list(F.when(~F.col(passed), F.col(key)))).alias("rejected"))


def video_hours_per_day(rows: DataFrame, seconds: str, minutes: str, nodes: int, gpus: int) -> DataFrame:
    return rows.withColumn("video_hours_per_day_per_gpu", F.col(seconds) * 24 / (60 * F.col(minutes) * nodes * gpus))


def top_rows(rows: DataFrame, by: str, tie: str, n: int) -> DataFrame:
    """The n rows of greatest ``by``, ties by ``tie``: a report, not a filter."""
    return rows.orderBy(F.col(by).desc(), tie).limit(n)


def folded_profiles(sessions: DataFrame, stack: str, samples: str) -> DataFrame:
    """Samples of each call stack added up over all profiling sessions, with the share of all and the stack's depth."""
    sums = sessions.groupBy(stack).agg(F.sum(samples).alias("samples"))
    whole = sums.agg(F.sum("samples").alias("all"))
    return sums.select(stack, "samples", F.round(F.col("samples") / whole.scalar(), 6).alias("share"), F.size(F.split(stack, ";")).cast("long").alias("depth"))
