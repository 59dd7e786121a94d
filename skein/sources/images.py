"""Images without a codec library: format and size from the header, pixels of plain PNG files; failures are data."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values of the formats: magics, JPEG's frame markers, and the channels of PNG colour types of 8 bits.
PNG = b"\x89PNG\r\n\x1a\n"
JPEG_FRAMES = {*range(0xC0, 0xD0)} - {0xC4, 0xC8, 0xCC}
PNG_CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}


def described(data: bytes) -> tuple[str, int, int]:
    """(format, width, height) of PNG, JPEG, GIF, BMP and WebP headers."""
    if data.startswith(PNG):
        return ("png", *struct.unpack_from(">II", data, 16))
    if data[:6] in (b"GIF87a", b"GIF89a"):
        return ("gif", *struct.unpack_from("<HH", data, 6))
    if data[:2] == b"BM":
        w, h = struct.unpack_from("<ii", data, 18)
        return "bmp", w, abs(h)
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        kind = data[12:16]
        if kind == b"VP8X":
            return "webp", 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little")
        if kind == b"VP8L":
            (bits,) = struct.unpack_from("<I", data, 21)
            return "webp", 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
        w, h = struct.unpack_from("<HH", data, 26)
        return "webp", w & 0x3FFF, h & 0x3FFF
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(data):
            if data[at] != 0xFF:
                raise ValueError("a JPEG marker is missing")
            if data[at + 1] in JPEG_FRAMES:
                h, w = struct.unpack_from(">HH", data, at + 5)
                return "jpeg", w, h
            at += 2 + struct.unpack_from(">H", data, at + 2)[0]
        raise ValueError("a JPEG file without a frame")
    raise ValueError("not a known image format")


def png_pixels(data: bytes) -> np.ndarray:
    """Height x width x channels of a PNG file of 8 bits without interlacing or palette."""
    width, height, depth, colour, _, _, interlace = struct.unpack_from(">IIBBBBB", data, 16)
    if depth != 8 or interlace or colour not in PNG_CHANNELS:
        raise ValueError("only plain PNG files of 8 bits are decoded")
    at, parts = 8, []
    while at + 8 <= len(data):
        n, kind = struct.unpack_from(">I4s", data, at)
        if kind == b"IDAT":
            parts.append(data[at + 8 : at + 8 + n])
        at += 12 + n
    channels = PNG_CHANNELS[colour]
    rows = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(height, 1 + width * channels)
    out = np.zeros((height + 1, width * channels), np.int64)
    for y in range(height):
        out[y + 1] = _unfiltered(rows[y, 0], rows[y, 1:].astype(np.int64), out[y], channels)
    return out[1:].astype(np.uint8).reshape(height, width, channels)


def _unfiltered(kind: int, row: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """A line before its filter: none, left, up, mean of both, or the best predictor of left, up and upper left."""
    if kind == 0:
        return row
    if kind == 2:
        return (row + above) % 256
    if kind == 1:
        return np.cumsum(row.reshape(-1, step), axis=0).reshape(-1) % 256
    out = row.copy()
    for i in range(len(row)):
        left, corner = (out[i - step], above[i - step]) if i >= step else (0, 0)
        if kind == 3:
            guess = (left + above[i]) // 2
        else:
            near = left + above[i] - corner
            guess = min((left, above[i], corner), key=lambda c, near=near: abs(near - c))
        out[i] = (row[i] + guess) % 256
    return out


def to_png(pixels: np.ndarray) -> bytes:
    """A PNG file of a height x width x channels array of bytes, lines unfiltered."""
    height, width, channels = pixels.shape
    colour = next(k for k, n in PNG_CHANNELS.items() if n == channels)
    raw = np.concatenate([np.zeros((height, 1), np.uint8), pixels.reshape(height, -1)], axis=1).tobytes()
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def loaded(files: DataFrame, content: str = "content") -> DataFrame:
    """``files`` with ``format``, ``width``, ``height`` and ``errors`` (map from step to message); every row stays."""
    added = T.StructType.fromDDL("format string, width int, height int, errors map<string,string>")
    schema = T.StructType([*files.schema.fields, *added.fields])

    def run(batches):
        for b in batches:
            made = []
            for data in b.column(content).to_pylist():
                try:
                    made.append((*described(data or b""), []))
                except (ValueError, IndexError, struct.error) as e:  # a file that is no image is data here
                    made.append((None, None, None, [("load", f"{type(e).__name__}: {e}")]))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.map_(pa.string(), pa.string())]
            columns = [pa.array(c, k) for c, k in zip(zip(*made), kinds)] if made else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], names=schema.names)

    return files.mapInArrow(run, schema)
