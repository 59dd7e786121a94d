"""MCAP recordings, read through Spark's binaryFile source: messages of a topic with log times in [start, end).

The format is a magic, records of (opcode, length, body), and chunks that hold records again; uncompressed and zstd
chunks are read. A chunk outside the time range is not searched for messages: its header has the range.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format: its magic and the opcodes used here.
MAGIC = b"\x89MCAP0\r\n"
CHANNEL, MESSAGE, CHUNK = 0x04, 0x05, 0x06


def _text(data: bytes, at: int) -> tuple[str, int]:
    (n,) = struct.unpack_from("<I", data, at)
    return data[at + 4 : at + 4 + n].decode(), at + 4 + n


def records(data: bytes, at: int = 0) -> Iterator[tuple[int, bytes]]:
    """(opcode, body) of consecutive records; a cut one at the end is left out."""
    while at + 9 <= len(data):
        op, n = struct.unpack_from("<BQ", data, at)
        if at + 9 + n > len(data):
            return
        yield op, data[at + 9 : at + 9 + n]
        at += 9 + n


def messages(data: bytes, topic: str, start: int, end: int, topics: dict[int, str] | None = None) -> Iterator[tuple[int, int, bytes]]:
    """(log time, sequence, payload) of a topic's messages in file order."""
    topics = {} if topics is None else topics
    for op, body in records(data):
        if op == CHANNEL:
            (number,) = struct.unpack_from("<H", body)
            topics[number] = _text(body, 4)[0]
        elif op == MESSAGE:
            number, seq, log, _ = struct.unpack_from("<HIQQ", body)
            if topics.get(number) == topic and start <= log < end:
                yield log, seq, body[22:]
        elif op == CHUNK:
            lo, hi, _, _ = struct.unpack_from("<QQQI", body)
            kind, at = _text(body, 28)
            (n,) = struct.unpack_from("<Q", body, at)
            inner = body[at + 8 : at + 8 + n]
            if kind == "zstd":
                import zstandard

                inner = zstandard.ZstdDecompressor().decompressobj().decompress(inner)
            elif kind:
                raise ValueError(f"chunks of kind {kind} are not read")
            outside = hi < start or lo >= end
            if outside:  # channels it introduces may be used later
                for o, b in records(inner):
                    if o == CHANNEL:
                        topics[struct.unpack_from("<H", b)[0]] = _text(b, 4)[0]
            else:
                yield from messages(inner, topic, start, end, topics)


def written(topic: str, rows: list[tuple[int, int, bytes]]) -> bytes:
    """A recording of one topic's (log time, sequence, payload) messages in one zstd chunk."""
    import zstandard

    text = lambda t: struct.pack("<I", len(t.encode())) + t.encode()
    record = lambda op, body: struct.pack("<BQ", op, len(body)) + body
    inner = record(CHANNEL, struct.pack("<HH", 1, 0) + text(topic) + text("raw") + struct.pack("<I", 0)) + b"".join(record(MESSAGE, struct.pack("<HIQQ", 1, seq, log, log) + data) for log, seq, data in rows)
    times = [r[0] for r in rows] or [0]
    packed = zstandard.ZstdCompressor().compress(inner)
    return MAGIC + record(CHUNK, struct.pack("<QQQI", min(times), max(times), len(inner), 0) + text("zstd") + struct.pack("<Q", len(packed)) + packed)


def recorded(rows: DataFrame, key: str, topic: str, log_time: str, payload: str) -> DataFrame:
    """(path, content): a recording for each key, messages numbered in log-time order. A key is one recording."""
    packed = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(log_time).alias("t"), F.col(payload).alias("p")))).alias("m"))

    def run(batches):
        for b in batches:
            made = [written(topic, [(x["t"], i, x["p"]) for i, x in enumerate(m)]) for m in b.column("m").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(made, pa.binary())], names=["path", "content"])

    return packed.select(F.concat(F.col(key).cast("string"), F.lit(".mcap")).alias("path"), "m").mapInArrow(run, "path string, content binary")


def scanned(spark: SparkSession, path: str, topic: str, start: int = 0, end: int = 2**63 - 1) -> DataFrame:
    """file, log_time_ns, sequence and data of a topic's messages in [start, end), in log-time order within a file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.mcap").load(path).select("path", "content")

    def run(batches):
        for b in batches:
            for name, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                if not data.startswith(MAGIC):
                    raise ValueError(f"{name} is no MCAP file")
                found = sorted(messages(data[len(MAGIC) :], topic, start, end), key=lambda m: m[:2])
                cols = list(zip(*found)) or [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())], names=["file", "log_time_ns", "sequence", "data"])

    return files.mapInArrow(run, "file string, log_time_ns long, sequence long, data binary")


def session_timestamps(lines: DataFrame, cameras: dict[int, int] | None = None) -> DataFrame:
    """(camera, ms) rows of text lines ``camera,ms``: bad lines are left out, camera numbers mapped where a map is given."""
    parts = F.split(F.trim("value"), r"\s*,\s*")
    rows = lines.filter(F.col("value").rlike(r"^\s*\d+\s*,\s*\d+\s*$")).select(parts[0].cast("int").alias("camera"), parts[1].cast("long").alias("ms"))
    if cameras is None:
        return rows
    mapping = F.create_map(*(F.lit(x) for kv in cameras.items() for x in kv))
    return rows.withColumn("camera", mapping[F.col("camera")]).filter(F.col("camera").isNotNull())
