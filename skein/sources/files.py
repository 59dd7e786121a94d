"""File sources: listings with planning rules, input lists, clip metadata, archives, SQLite tables, JDBC queries.

Listings go through Spark's binaryFile source with the content column pruned, so they work on every store that Spark
reads and need no driver-side loop.
"""

from __future__ import annotations

import json
import tarfile
import time
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.functions.text import has_extension, is_uuid, parent_folder, relative_path
from skein.sources import embedded

VIDEO = ("mp4", "mov", "avi", "mkv", "webm", "h264")
IMAGE = ("jpg", "jpeg", "png", "webp", "bmp", "gif", "tif", "tiff")

#: Clip metadata; every optional key is a nullable column, so runs without captions have the same schema.
CLIP_SCHEMA = (
    "span_uuid string, source_video string, duration_span array<double>, width_source int, height_source int, framerate_source double, clip_location string, "
    "width int, height int, framerate double, num_frames int, video_codec string, num_bytes bigint, motion_score struct<global_mean:double,per_patch_min_256:double>, "
    "aesthetic_score double, errors array<string>, windows array<map<string,string>>, valid boolean, has_caption boolean"
)


def listed(spark: SparkSession, folder: str, *extensions: str) -> DataFrame:
    """path, relative path, size and time of all files below a folder, of the given extensions if any."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")
    base = F.concat(F.regexp_replace(F.lit(folder.rstrip("/")), "^file:/*", "/"), F.lit("/"))
    plain = F.regexp_replace("path", "^file:/*", "/")
    out = files.withColumn("relative", F.when(F.startswith(plain, base), F.substr(plain, F.length(base) + 1)).otherwise(F.col("path")))
    return out.filter(has_extension(F.col("path"), *extensions)) if extensions else out


def top_folders(files: DataFrame) -> DataFrame:
    """Distinct first path components of a listing."""
    return files.filter(F.contains("relative", F.lit("/"))).select(F.split_part("relative", F.lit("/"), F.lit(1)).alias("folder")).distinct()


def sessions(files: DataFrame) -> DataFrame:
    """Multi-camera sessions: folders named by a UUID, with their videos."""
    first = F.split_part("relative", F.lit("/"), F.lit(1))
    return files.filter(has_extension(F.col("path"), *VIDEO)).withColumn("session", first).filter(is_uuid(F.col("session")))


def parent_counts(files: DataFrame) -> DataFrame:
    return files.groupBy(parent_folder(F.col("path")).alias("folder")).agg(F.count("*").alias("n_files"))


def input_list(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """Paths of a JSON array, relative to the prefix; a path elsewhere is an error."""
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("path"))
    inside = F.startswith(F.col("path"), F.lit(prefix.rstrip("/") + "/"))
    return raw.withColumn("relative", F.when(inside, relative_path(F.col("path"), prefix)).otherwise(F.raise_error(F.concat(F.lit("not below the prefix: "), F.col("path")))))


def session_file(spark: SparkSession, path: str) -> DataFrame:
    """Distinct parent folders of the lines that name a video."""
    return spark.read.text(path).filter(has_extension(F.trim("value"), *VIDEO)).select(parent_folder(F.trim("value")).alias("session")).distinct()


def clip_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Valid clips of a folder of metadata files, by the explicit schema."""
    return spark.read.schema(CLIP_SCHEMA).option("recursiveFileLookup", "true").json(folder, multiLine=True).filter("valid")


def embeddings(spark: SparkSession, paths: list[str] | None, folder: str) -> DataFrame:
    """id and embedding of the listed files, or of all below the folder if none are listed."""
    return spark.read.option("recursiveFileLookup", "true").parquet(*(paths or [folder])).select("id", "embedding")


def parquet_files(spark: SparkSession, folder: str, limit: int = 0) -> DataFrame:
    """Listing of the Parquet files below a folder, by path; ``limit`` keeps the first ones only."""
    found = listed(spark, folder, "parquet").orderBy("path")
    return found.limit(limit) if limit else found


def read(paths: DataFrame, path: str = "path", attempts: int = 3, kind: str = "bytes") -> DataFrame:
    """``paths`` with ``content`` (bytes, or text for kinds text and json) and ``errors``, each file tried ``attempts`` times.

    Reads go through Arrow's file systems. A file that cannot be read, or json that does not parse, keeps its row.
    """
    out = "binary" if kind == "bytes" else "string"
    schema = T.StructType([*paths.schema.fields, *T.StructType.fromDDL(f"content {out}, errors map<string,string>").fields])

    def one(name: str):
        from pyarrow import fs

        from skein.sources.sinks import uri

        for k in range(attempts):
            try:
                system, at = fs.FileSystem.from_uri(uri(name))
                with system.open_input_stream(at) as f:
                    data = f.read()
                if kind == "bytes":
                    return data, []
                if kind == "json":
                    json.loads(data)
                return data.decode(), []
            except (OSError, ValueError) as e:  # a file that cannot be read is data here
                error = type(e).__name__
                time.sleep(0.01 * 2**k)
        return None, [("read", error)]

    def run(batches):
        for b in batches:
            made = [one(p) for p in b.column(path).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([c for c, _ in made], pa.binary() if kind == "bytes" else pa.string()), pa.array([e for _, e in made], pa.map_(pa.string(), pa.string()))], names=schema.names)

    return paths.mapInArrow(run, schema)


#: Bytes of members that are handed on at once.
PART_BYTES = 1 << 20


def members(kind: str, data: pa.Buffer | bytes) -> Iterator[tuple[str, bytes]]:
    """Names and contents of a tar or zip archive's files, one after the other."""
    with pa.BufferReader(data) as whole:
        if kind == "zip":
            with zipfile.ZipFile(whole) as z:
                yield from ((i.filename, z.read(i)) for i in z.infolist() if not i.is_dir())
        else:
            with tarfile.open(fileobj=whole) as t:
                while m := t.next():
                    if m.isfile():
                        yield m.name, t.extractfile(m).read()
                    t.members.clear()


def _parts(rows: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of texts that end in a content, as batches of about ``PART_BYTES``."""
    held, n_bytes = [], 0

    def out():
        *texts, contents = zip(*held)
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in texts), pa.array(contents, pa.binary())], names=names)

    for row in rows:
        held.append(row)
        n_bytes += len(row[-1])
        if n_bytes >= PART_BYTES:
            yield out()
            held, n_bytes = [], 0
    if held:
        yield out()


def unpacked(archives: DataFrame, kind: str = "zip") -> DataFrame:
    """(path, content) of every member of archives (content): for a sink of files, so that a zip of inputs becomes inputs."""

    def run(batches):
        for b in batches:
            for data in b.column("content"):
                inside = (m for m in members(kind, data.as_buffer()) if not m[0].startswith("/") and ".." not in m[0].split("/"))  # none outside the folder
                yield from _parts(inside, ["path", "content"])

    return archives.select("content").mapInArrow(run, "path string, content binary")


def archive_samples(spark: SparkSession, folder: str, kind: str = "tar") -> DataFrame:
    """archive, key (member path without suffix) and a map from suffix to content; a suffix twice is an error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{kind}").load(folder).select("path", "content")

    def run(batches):
        for b in batches:
            for path, data in zip(b.column("path").to_pylist(), b.column("content")):
                rows = ((path, *(n.rsplit(".", 1) if "." in n.rsplit("/", 1)[-1] else (n, "")), c) for n, c in members(kind, data.as_buffer()))
                yield from _parts(rows, ["archive", "key", "suffix", "payload"])

    each = files.mapInArrow(run, "archive string, key string, suffix string, payload binary")
    packed = each.groupBy("archive", "key").agg(F.collect_list(F.struct("suffix", "payload")).alias("m"), F.count("*").alias("n"), F.count_distinct("suffix").alias("d"))
    entries = F.when(F.col("n") == F.col("d"), F.col("m")).otherwise(F.raise_error(F.concat(F.lit("a suffix occurs twice: "), F.col("key"))))
    return packed.select("archive", "key", F.map_from_entries(entries).alias("data"))


def jdbc_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A query's rows; column names and values are Spark's to push down. Of database files, a copy of now is read."""
    url = embedded.snapshot(spark, url) if embedded.is_embedded(url) else url
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**options).load()
