"""Packages of clips: three archives a shard, session archives, text-embedding archives in two layouts, dataset exports.

All give rows (path, name, data) that :func:`skein.sources.sinks.archives` packs or (path, content) that
:func:`skein.sources.sinks.write_files` writes.
"""

from __future__ import annotations

import pickle

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skein.functions import ids

# The three archives of a shard and what they hold.
SHARD_KINDS = ("video", "metas", "t5_xxl")
#: Text embeddings of an archive in the layout by part.
PER_TAR = 16


def pickled(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with an array column as the bytes of a pickled list."""
    schema = rows.drop(column).schema.add(column, "binary")

    def run(batches):
        for b in batches:
            made = [None if x is None else pickle.dumps(x, protocol=4) for x in b.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in schema.names[:-1]), pa.array(made, pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema)


def shard_members(samples: DataFrame, key: str, group: Column, video: str, metadata: Column, embeddings: str) -> DataFrame:
    """(path, name, data) of three archives a group: videos, metadata as JSON and pickled embeddings, named by clip.

    ``group`` is the archive's path below each kind. A sample without its video is an error, unlike anywhere else.
    """
    rows = samples.withColumn("__path", group).withColumn("__json", F.encode(metadata, "utf-8"))
    rows = rows.withColumn("__video", F.when(F.col(video).isNotNull(), F.col(video)).otherwise(F.raise_error(F.concat(F.lit("no video of clip "), F.col(key).cast("string"))).cast("binary")))
    made = pickled(rows.select(key, "__path", "__video", "__json", embeddings), embeddings)
    each = [F.struct(F.lit(kind).alias("kind"), F.lit(suffix).alias("suffix"), F.col(c).alias("data")) for kind, suffix, c in zip(SHARD_KINDS, ("mp4", "json", "pickle"), ("__video", "__json", embeddings))]
    out = made.select(key, "__path", F.inline(F.array(*each)))
    return out.select(F.concat_ws("/", "kind", "__path").alias("path"), F.concat_ws(".", F.col(key).cast("string"), "suffix").alias("name"), "data")


def whole_sessions(clips: DataFrame, session: str, camera: str, cameras: dict[int, str]) -> DataFrame:
    """The clips of the mapped cameras, with their ``camera_name``, of sessions that have them all."""
    names = F.create_map(*(F.lit(x) for kv in cameras.items() for x in kv))
    own = clips.filter(F.col(camera).isin(*cameras)).withColumn("camera_name", names[F.col(camera)])
    full = own.groupBy(session).agg(F.count_distinct(camera).alias("n")).filter(F.col("n") == len(cameras)).select(session)
    return own.join(full, session)


def session_members(clips: DataFrame, session: str, prefix: str, video: str, times_ms: str, trajectory: str | None = None) -> DataFrame:
    """(path, name, data) of one archive a session: each camera's video, frame times as JSON and, if any, its trajectory."""
    frames = F.to_json(F.transform(times_ms, lambda t, i: F.struct(i.alias("frame_num"), t.cast("long").alias("timestamp"))))
    items = [("mp4", F.col(video)), ("json", F.encode(frames, "utf-8"))] + ([("bin", F.col(trajectory))] if trajectory else [])
    each = F.filter(F.array(*(F.struct(F.lit(s).alias("suffix"), d.alias("data")) for s, d in items)), lambda x: x["data"].isNotNull())
    out = clips.select(session, "camera_name", F.inline(each))
    name = F.concat_ws(".", F.col(session).cast("string"), "camera_name", "suffix")
    return out.select(F.concat(F.lit(f"{prefix}/"), F.col(session).cast("string"), F.lit(".tar")).alias("path"), name.alias("name"), "data")


def caption_members(clips: DataFrame, session: str, clip: str, variants: list[str], embeddings: str, captions: str, starts: str, ends: str) -> DataFrame:
    """(path, name, data) of one archive a variant and session: each camera's pickled embedding and its caption with window.

    The arrays have a place for each variant.
    """
    named = (F.col(c).alias(n) for c, n in ((embeddings, "e"), (captions, "c"), (starts, "a"), (ends, "z")))
    zipped = clips.select(session, clip, "camera_name", *named).select(session, clip, "camera_name", F.posexplode(F.arrays_zip("e", "c", "a", "z")).alias("k", "w"))
    rows = pickled(zipped.select(session, clip, "camera_name", "k", "w.*"), "e")
    variant = F.element_at(F.array(*(F.lit(v) for v in variants)), F.col("k") + 1)
    meta = F.concat(F.lit('["'), F.col(clip).cast("string"), F.lit('", '), F.to_json(F.array("c")), F.lit(", ["), F.col("a").cast("string"), F.lit("], ["), F.col("z").cast("string"), F.lit("]]"))
    each = F.inline(F.array(F.struct(F.lit("bin").alias("suffix"), F.col("e").alias("data")), F.struct(F.lit("json").alias("suffix"), F.encode(meta, "utf-8").alias("data"))))
    out = rows.select(session, "camera_name", variant.alias("variant"), each)
    name = F.concat_ws(".", F.col(session).cast("string"), "camera_name", "suffix")
    return out.select(F.concat(F.concat_ws("/", "variant", F.col(session).cast("string")), F.lit(".tar")).alias("path"), name.alias("name"), "data")


def numbered_members(clips: DataFrame, part: str, session: str, variants: list[str], embeddings: str, per_tar: int = PER_TAR) -> DataFrame:
    """(path, name, data) of the layout by part: archives of ``per_tar`` embeddings each, by session, then camera.

    A part is one task's share of sessions, so its rows are bounded by the caller.
    """
    order = W.partitionBy(part).orderBy(session, "camera_name")
    numbered = clips.withColumn("__tar", F.floor((F.row_number().over(order) - 1) / per_tar).cast("long"))
    rows = pickled(numbered.select(part, session, "camera_name", "__tar", F.posexplode(embeddings).alias("k", "e")), "e")
    variant = F.element_at(F.array(*(F.lit(v) for v in variants)), F.col("k") + 1)
    path = F.concat_ws("/", variant, ids.part_path(F.col(part)), F.concat(F.lit("t5_"), ids.tar_path(F.col("__tar"))))
    return rows.select(path.alias("path"), F.concat_ws(".", F.col(session).cast("string"), "camera_name", F.lit("bin")).alias("name"), F.col("e").alias("data"))


def clip_files(clips: DataFrame, clip: str, relative: str, camera_rank: str, video: str, previews: str, embedding: str, metadata: Column, vectors: str = "embeddings") -> DataFrame:
    """(path, content) of every file of a run's clips, rejected ones (``stage_rejected``) in a folder of their own.

    Every camera's clip has its video below its own relative path. The rest is shared by the cameras of a session, so only
    the primary one writes it: metadata of all clips, previews of each window and the embedding of kept ones.
    """
    kept, primary = F.col("stage_rejected").isNull(), F.col(camera_rank) == 0
    rows = pickled(clips.withColumn("__meta", metadata), embedding)
    name = F.col(clip).cast("string")
    own = F.struct(F.concat_ws("/", F.when(kept, "clips").otherwise("filtered_clips"), relative, F.concat(name, F.lit(".mp4"))).alias("path"), F.col(video).alias("content"))
    meta = F.struct(F.concat(F.lit("metas/v0/"), name, F.lit(".json")).alias("path"), F.when(primary, F.encode("__meta", "utf-8")).alias("content"))
    vector = F.struct(F.concat(F.lit(f"{vectors}/"), name, F.lit(".pickle")).alias("path"), F.when(primary & kept, F.col(embedding)).alias("content"))
    windows = F.transform(F.when(primary & kept, F.col(previews)).otherwise(F.array().cast("array<binary>")), lambda p, i: F.struct(F.concat(F.lit("previews/"), name, F.lit("_"), i.cast("string"), F.lit(".webp")).alias("path"), p.alias("content")))
    return rows.select(F.inline(F.filter(F.concat(F.array(own, meta, vector), windows), lambda x: x["content"].isNotNull())))


def marker_files(chunks: DataFrame, video: str, chunk: str, n_chunks: str, record: Column) -> DataFrame:
    """(path, content) of the markers that tell finished videos: one for each chunk, and the video's own from its first."""
    own = F.struct(F.concat(F.lit("processed_clip_chunks/"), F.col(video), F.lit("_"), F.col(chunk).cast("string"), F.lit(".json")).alias("path"), F.encode(record, "utf-8").alias("content"))
    whole = F.struct(F.concat(F.lit("processed_videos/"), F.col(video), F.lit(".json")).alias("path"), F.when(F.col(chunk) == 0, F.encode(F.to_json(F.struct(F.col(n_chunks).alias("num_clip_chunks"))), "utf-8")).alias("content"))
    return chunks.select(F.inline(F.filter(F.array(own, whole), lambda x: x["content"].isNotNull())))


def exported(clips: DataFrame, dataset: str, clip: str, view: str, video: str, caption: str, embedding: str) -> DataFrame:
    """(path, content) of a dataset of single files: each clip's video, caption text and pickled embedding, by view."""
    rows = pickled(clips.select(clip, view, video, caption, embedding), embedding)
    place = F.concat_ws("/", F.col(view), F.col(clip).cast("string"))
    each = [("videos", "mp4", F.col(video)), ("metas", "txt", F.encode(caption, "utf-8")), ("t5_xxl", "pickle", F.col(embedding))]
    files = F.array(*(F.struct(F.concat(F.lit(f"{dataset}/{folder}/"), place, F.lit(f".{suffix}")).alias("path"), data.alias("content")) for folder, suffix, data in each))
    return rows.select(F.inline(F.filter(files, lambda x: x["content"].isNotNull())))


def prefix_cache(views: DataFrame, dataset: str, view: str, embedding: str) -> DataFrame:
    """(path, content): the pickled embedding of the prompt's prefix once a view."""
    return pickled(views.select(view, embedding), embedding).select(F.concat(F.lit(f"{dataset}/cache/prefix_t5_embeddings_"), F.col(view), F.lit(".pickle")).alias("path"), F.col(embedding).alias("content"))
