"""Media columns: lossless WAV storage of bytes, short-time Fourier transforms and spectral-peak fingerprints.

A payload is stored as unsigned 8-bit mono samples by the wave module and read back by it; features come from the bytes
read back, never from the input. The transform takes Hann windows of ``FRAME`` samples every ``HOP`` samples, the last
one padded with silence. In each frame the strongest bin of every frequency band is a peak candidate; it is a peak if
its magnitude is above ``FLOOR`` times the frame's mean. Each peak is paired with the peaks of the next ``FAN`` frames
in the same or the neighbouring band, and a pair is one fingerprint: both bins and the frame distance in an integer,
with the first peak's frame as its time code. A payload of one frame has no pairs so; its frames begin
at every ``SHORT_HOP`` samples up to its end, every candidate is a peak, zeros at its end count as silence, and its
distances are written as ``FAN`` more. The work of a payload goes through blocks of frames, so its length does
not matter for memory.

Null texts read as empty, null ids stay null, repeated rows are stored alike, an empty payload is 64 zero bytes, equal texts give equal values, ties between bins go to
the lower one, and an empty table gives no rows. Other columns pass through ``with_fingerprints``.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skein.llm.text import filled, slices, small_batches

RATE = 8000
FRAME, HOP = 256, 128
#: Samples between the frames of a payload that fills one frame at most.
SHORT_HOP = 1
#: Band edges in bins, about an octave each.
BANDS = (2, 8, 16, 32, 64, 129)
FLOOR = 2.0
FAN = 2
BLOCK_FRAMES = 1024
WINDOW = np.hanning(FRAME + 1)[:FRAME].astype(np.float32)


def padded(data: bytes) -> bytes:
    """The bytes with zeros up to a positive multiple of 64."""
    return data + bytes(64 * max(1, -(-len(data) // 64)) - len(data))


def to_wav(payload: bytes) -> bytes:
    """A WAV file that holds the payload as unsigned 8-bit mono samples."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(stored: bytes) -> bytes:
    with wave.open(io.BytesIO(stored), "rb") as w:
        return w.readframes(w.getnframes())


def spectrum(samples: np.ndarray, hop: int = HOP) -> np.ndarray:
    """Magnitudes, a row for each frame, of samples that fill whole frames."""
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::hop]
    return np.abs(np.fft.rfft(frames * WINDOW, axis=1))


def peaks(magnitudes: np.ndarray, floor: float = FLOOR) -> tuple[np.ndarray, np.ndarray]:
    """Bin and presence of the peak of each frame and band."""
    bins = np.stack([magnitudes[:, a:b].argmax(1) + a for a, b in zip(BANDS, BANDS[1:])], axis=1)
    tops = np.take_along_axis(magnitudes, bins, 1)
    return bins.astype(np.int64), tops > floor * magnitudes[:, BANDS[0] :].mean(1, keepdims=True)


def fingerprints(samples: bytes, hop: int = HOP, floor: float = FLOOR) -> tuple[np.ndarray, np.ndarray]:
    """Time codes (frame numbers) and pair codes of 8-bit samples, by time, then code."""
    data = np.frombuffer(samples, np.uint8)
    n = 1 + max(0, -(-(len(data) - FRAME) // HOP)) if hop == HOP else -(-len(data) // hop)
    all_bins, all_there = [], []
    for lo in range(0, n, BLOCK_FRAMES):
        hi = min(n, lo + BLOCK_FRAMES)
        part = data[lo * hop : (hi - 1) * hop + FRAME]
        signal = np.zeros((hi - lo - 1) * hop + FRAME, np.float32)
        signal[: len(part)] = (part.astype(np.float32) - 128) / 128
        bins, there = peaks(spectrum(signal, hop), floor)
        all_bins.append(bins)
        all_there.append(there)
    bins, there = np.concatenate(all_bins), np.concatenate(all_there)
    times, codes = [], []
    bands = len(BANDS) - 1
    for step in range(1, FAN + 1):
        for up in (0, 1):
            both = there[:-step, : bands - up] & there[step:, up:] if n > step else np.zeros((0, bands - up), bool)
            t, b = np.nonzero(both)
            times.append(t)
            codes.append(bins[t, b] << 16 | bins[t + step, b + up] << 4 | step)
    t, c = np.concatenate(times), np.concatenate(codes)
    order = np.lexsort((c, t))
    return t[order].astype(np.int32), c[order].astype(np.int32)


def features(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of any payload; those of at most a frame have frames at a smaller hop."""
    if len(samples) > FRAME:
        return fingerprints(samples)
    heard = samples.rstrip(b"\0")
    ahead = b"\x80" * 4 if heard else b""  # a window is silent at its first sample
    times, codes = fingerprints(ahead + heard.ljust(len(samples), b"\x80"), SHORT_HOP, 0.0)
    return times, codes + np.int32(FAN)


def with_fingerprints(docs: DataFrame, text: str = "text", media: str = "wav", times: str = "peak_times", codes: str = "peak_codes") -> DataFrame:
    """``docs`` with the WAV file of every text's bytes and its fingerprint as time-coded arrays."""
    if clash := {media.lower(), times.lower(), codes.lower()} & {c.lower() for c in docs.columns}:
        raise ValueError(f"the input has columns named {sorted(clash)}")
    small_batches(docs.sparkSession)
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([*docs.schema.fields, T.StructField(media, T.BinaryType()), T.StructField(times, ints), T.StructField(codes, ints)])

    def run(batches):
        for piece in slices(batches, text):
            stored = [to_wav(padded(t.encode())) for t in filled(piece.column(text)).to_pylist()]
            made = [features(from_wav(s)) for s in stored]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(stored, pa.binary()), pa.array([t for t, _ in made], pa.list_(pa.int32())), pa.array([c for _, c in made], pa.list_(pa.int32()))], names=schema.names)

    return docs.mapInArrow(run, schema)


def digest(data: bytes) -> tuple:
    """The contract's columns of one text's bytes."""
    stored = to_wav(padded(data))
    payload = from_wav(stored)
    times, codes = features(payload)
    feature = f"{len(codes)}:{hashlib.sha256(times.tobytes() + codes.tobytes()).hexdigest()}"
    return len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), feature


def op6_wav_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op6: every whole document stored as WAV, read back and fingerprinted, by digest."""
    small_batches(spark)
    fields = [("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]

    def run(batches):
        for piece in slices(batches, "text"):
            rows = list(zip(*(digest(t.encode()) for t in filled(piece.column("text")).to_pylist())))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *(pa.array(v, t) for v, (_, t) in zip(rows, fields))], names=["doc_id", *(n for n, _ in fields)])

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return docs.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
