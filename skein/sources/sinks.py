"""Sinks: frames in the formats of the pipelines, archives by group, and rules for destinations that exist."""

from __future__ import annotations

import io
import struct
import tarfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEEP, OVERWRITE, BACKUP = "keep", "overwrite", "backup"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def backup(spark: SparkSession, path: str) -> str | None:
    """Renames an existing destination to the next free ``path.bak-N``; the new name, or None if there was none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    n = 0
    while fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}.bak-{n}")):
        n += 1
    fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(f"{path}.bak-{n}"))
    return f"{path}.bak-{n}"


def write(df: DataFrame, path: str, kind: str = "parquet", existing: str = KEEP, partition_by: list[str] | None = None, one_file: bool = False) -> None:
    """A frame as parquet, json (a line each row), csv or text. ``existing``: keep the old, overwrite, or back it up.

    ``one_file`` is for summaries: a few rows that someone opens by hand.
    """
    if existing == BACKUP:
        backup(df.sparkSession, path)
    writer = (df.coalesce(1) if one_file else df).write.mode({KEEP: "ignore", OVERWRITE: "overwrite", BACKUP: "errorifexists"}[existing])
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.option("header", "true") if kind == "csv" else writer.option("ignoreNullFields", "true") if kind == "json" else writer
    writer.format(kind).save(path)


def routed(clips: DataFrame, path: str, kind: str = "parquet", existing: str = OVERWRITE) -> None:
    """Kept and rejected clips in folders of their own, from one pass."""
    write(clips.withColumn("route", F.when(F.col("stage_rejected").isNull(), "clips").otherwise("filtered_clips")), path, kind, existing, ["route"])


def vector_rows(clips: DataFrame, key: str, embedding: str, captions: str) -> DataFrame:
    """Rows for a vector store: id, vector and its metadata as JSON, captions joined by `` | ``."""
    return clips.select(F.col(key).alias("id"), F.col(embedding).alias("embedding"), F.to_json(F.struct(F.array_join(captions, " | ").alias("caption"))).alias("$meta"))


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Appends the rows whose key the destination lacks: run twice, it changes nothing."""
    spark = df.sparkSession
    fs, p = _fs(spark, path)
    fresh = df.join(spark.read.parquet(path).select(key), key, "left_anti") if fs.exists(p) else df
    fresh.write.mode("append").parquet(path)


#: Rows of a batch that are Python objects at once.
ROWS = 64


def archives(rows: DataFrame, path: str, name: str, data: str, limit: int = 0) -> DataFrame:
    """(path, content, n_keys): a tar for each value of ``path``, members by name.

    Rows are sorted inside the shuffle and streamed, one archive held. The caller's packing bounds an archive's bytes, or
    ``limit`` does: then a path's members are dealt out by ranges of keys (names without suffix), and an archive that has so
    many bytes is closed before the next key. Their paths say which range they come from and which of it they are.
    """
    laid = rows.select(F.col(path).alias("path"), F.col(name).alias("name"), F.col(data).alias("data"))
    if limit:
        key = F.regexp_replace("name", r"\.[^./]*$", "")
        laid = laid.withColumn("key", key).repartitionByRange("path", "key").sortWithinPartitions("path", "key", "name")
    else:
        laid = laid.withColumn("key", F.lit("")).repartition("path").sortWithinPartitions("path", "name")

    def run(batches):
        from pyspark import TaskContext

        at, last, n_members, n_made, held, tar = None, None, 0, 0, None, None

        def out():
            nonlocal n_made, held, tar
            tar.close()
            stem, dot, suffix = at.rpartition(".") if "." in at.rsplit("/", 1)[-1] else (at, "", "")
            name = f"{stem}-{TaskContext.get().partitionId():06d}-{n_made:06d}{dot}{suffix}" if limit else at
            n_made += 1
            made = pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(struct.pack("=ii", 0, held.tell())), pa.py_buffer(held.getbuffer())])
            held = tar = None
            return pa.RecordBatch.from_arrays([pa.array([name]), made, pa.array([n_members], pa.int64())], names=["path", "content", "n_keys"])

        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                b = whole.slice(lo, ROWS)
                for p, n, key, d in zip(*(b.column(c).to_pylist() for c in ("path", "name", "key", "data"))):
                    if held is not None and (p != at or (limit and key != last and held.tell() >= limit)):
                        yield out()
                    if held is None:
                        held, n_members = io.BytesIO(), 0
                        tar = tarfile.open(fileobj=held, mode="w")
                    at, last, n_members = p, key, n_members + 1
                    info = tarfile.TarInfo(n)  # times and owners left out so that equal samples make equal archives
                    info.size = len(d)
                    tar.addfile(info, io.BytesIO(d))
                    tar.members.clear()  # a list of all members for readers
        if held is not None:
            yield out()

    return laid.select("path", "name", "key", "data").mapInArrow(run, "path string, content binary, n_keys long")


def collected(files: DataFrame, base: str) -> None:
    """Copies listed files (path, relative) below one folder: artifacts that runs left in several places."""
    from skein.sources.files import read

    got = read(files.select("path", "relative"))
    missing = F.raise_error(F.concat(F.lit("not collected: "), F.col("path"))).cast("binary")
    write_files(got.select(F.col("relative").alias("path"), F.coalesce("content", missing).alias("content")), base)


def uri(path: str) -> str:
    """A path as Arrow's file systems read it."""
    return path if "://" in path else f"file://{path.removeprefix('file:')}"


def write_files(files: DataFrame, base: str) -> None:
    """Each row (path, content) as a file below ``base``, through Arrow's file systems (local, s3, hdfs, gs).

    A file is written under a name of its own and renamed, so a task that is tried again leaves one whole file.
    """

    def put(rows):
        import uuid

        from pyarrow import fs

        from skein.sources.sinks import uri

        system, root = fs.FileSystem.from_uri(uri(base))
        for r in rows:
            target = f"{root}/{r.path}"
            system.create_dir(target.rsplit("/", 1)[0], recursive=True)
            part = f"{target}.{uuid.uuid4().hex}"
            with system.open_output_stream(part) as f:
                f.write(r.content)
            system.move(part, target)

    files.select("path", "content").foreachPartition(put)
