"""Video containers without a decoder: packet indexes and metadata of MP4 files and raw H.264 streams, and a muxer.

An MP4 file's sample tables are its index; a raw stream is split at its NAL units. Both give the same packets for the
same pictures. Files go through Spark's binaryFile source; what cannot be read is an entry in ``errors``, never a lost row.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from itertools import accumulate, chain, islice, repeat
from operator import add, itemgetter, sub
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values of the formats: boxes that hold boxes, sample entries of video, NAL types of slices, IDR, SPS, PPS and AUD.
CONTAINERS = (b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts")
CODECS = {b"avc1": "h264", b"avc3": "h264", b"hvc1": "hevc", b"hev1": "hevc", b"av01": "av1", b"vp09": "vp9", b"mp4v": "mpeg4"}
SLICE, IDR, SEI, SPS, PPS, AUD = 1, 5, 6, 7, 8, 9
HEAD, WORD, TWO = struct.Struct(">I4s").unpack_from, struct.Struct(">I").unpack_from, struct.Struct(">II").unpack_from
SECOND, MOST = 1_000_000_000, 2**63 - 1


class Packet(NamedTuple):
    offset: int
    size: int
    pts: int
    dts: int
    is_key: bool


class Track(NamedTuple):
    """``columns``: the packets' offsets, sizes, pts, dts and key flags, each as long as the others."""

    columns: tuple[list[int], list[int], list[int], list[int], list[bool]]
    timescale: int
    width: int
    height: int
    codec: str
    duration: int
    container: str

    @property
    def packets(self) -> list[Packet]:
        return [Packet(*x) for x in zip(*self.columns)]


def boxes(data: bytes, at: int = 0, end: int | None = None) -> Iterator[tuple[bytes, int, int]]:
    """(name, first byte of the body, end) of consecutive boxes; a cut one is an error."""
    end = len(data) if end is None else end
    while at + 8 <= end:
        size, name = HEAD(data, at)
        head = 8
        if size == 1:
            (size,) = struct.unpack_from(">Q", data, at + 8)
            head = 16
        size = size or end - at
        if size < head or at + size > end:
            raise ValueError(f"box {name!r} ends outside its parent")
        yield name, at + head, at + size
        at += size


def tree(data: bytes, at: int = 0, end: int | None = None) -> dict[bytes, list]:
    """Boxes by name: lists of nested dictionaries for containers, of (start, end) for others."""
    out: dict[bytes, list] = {}
    for name, a, b in boxes(data, at, end):
        out.setdefault(name, []).append(tree(data, a, b) if name in CONTAINERS else (a, b))
    return out


def _table(data: bytes, at: int, width: int = 1, kind: str = "I") -> tuple[int, ...]:
    """The numbers of a table of entries of ``width`` numbers, which its count of entries at ``at`` precedes."""
    return struct.unpack_from(f">{width * WORD(data, at)[0]}{kind}", data, at + 4)


def _repeated(table: tuple[int, ...], n: int) -> Iterator[int]:
    """The values of (count, value) entries, each as often as it counts, ``n`` at most."""
    return islice(chain.from_iterable(map(repeat, table[1::2], table[::2])), n)


def mp4_track(data: bytes, number: int = 0) -> Track:
    """The ``number``-th video track of an MP4 file, its packets in file (decode) order."""
    top = tree(data)
    if b"moov" not in top:
        raise ValueError("no moov box: not an MP4 file, or a cut one")
    videos = [t for t in top[b"moov"][0].get(b"trak", []) if data[(h := t[b"mdia"][0][b"hdlr"][0][0]) + 8 : h + 12] == b"vide"]
    if number >= len(videos):
        raise ValueError(f"no video track {number}")
    mdia = videos[number][b"mdia"][0]
    stbl = mdia[b"minf"][0][b"stbl"][0]
    a = mdia[b"mdhd"][0][0]
    timescale, duration = struct.unpack_from(">IQ", data, a + 20) if data[a] == 1 else struct.unpack_from(">II", data, a + 12)
    entry = stbl[b"stsd"][0][0] + 8
    codec = data[entry + 4 : entry + 8]
    width, height = struct.unpack_from(">HH", data, entry + 32)
    a = stbl[b"stsz"][0][0]
    fixed, n = TWO(data, a + 4)
    sizes = (fixed,) * n if fixed else struct.unpack_from(f">{n}I", data, a + 12)
    dts = list(accumulate(_repeated(_table(data, stbl[b"stts"][0][0] + 4, 2), n - 1), initial=0))[:n]
    pts = dts
    if b"ctts" in stbl:
        a = stbl[b"ctts"][0][0]
        entries = struct.unpack_from(">" + ("Ii" if data[a] == 1 else "II") * WORD(data, a + 4)[0], data, a + 8)
        pts = [*map(add, dts, _repeated(entries, n))]
    key = [b"stss" not in stbl] * n
    if b"stss" in stbl:
        for i in _table(data, stbl[b"stss"][0][0] + 4):
            key[i - 1] = True
    chunks = _table(data, stbl[b"co64"][0][0] + 4, kind="q") if b"co64" in stbl else _table(data, stbl[b"stco"][0][0] + 4)
    groups = _table(data, stbl[b"stsc"][0][0] + 4, 3)
    offsets: list[int] = []
    for first, last, each in zip(groups[::3], (*groups[3::3], len(chunks) + 1), groups[1::3]):
        if not 0 < first <= last <= len(chunks) + 1:
            raise ValueError("groups of chunks that are not there")
        for at in chunks[first - 1 : last - 1]:
            if own := sizes[len(offsets) : len(offsets) + each]:
                offsets += accumulate(own[:-1], initial=at)
    if not n == len(offsets) == len(pts) == len(dts):
        raise ValueError(f"{n} packets with {len(offsets)} places and {len(dts)}, {len(pts)} times")
    return Track((offsets, sizes, pts, dts, key), timescale, width, height, CODECS.get(codec, codec.decode("latin-1")), duration, "mp4")


START_CODE = re.compile(b"\0\0\1")


def nal_units(data: bytes) -> Iterator[tuple[int, int]]:
    """(start, end) of each NAL unit of a raw stream, start codes and trailing zeros left out."""
    at = [m.end() for m in START_CODE.finditer(data)]
    for a, b in zip(at, [*(x - 3 for x in at[1:]), len(data)]):
        yield a, a + len(data[a:b].rstrip(b"\0"))


def h264_units(data: bytes) -> list[tuple[int, int, bool]]:
    """(start, end, is_key) of the access units (pictures) of a raw H.264 stream, in file order.

    A unit begins at the first parameter set, SEI or delimiter after a picture, or at a slice of macroblock 0.
    """
    out, begin, has, key, last = [], None, False, False, 0
    for a, b in nal_units(data):
        kind = data[a] & 31 if a < b else 0
        first = kind in (SLICE, IDR) and a + 1 < b and bool(data[a + 1] & 0x80)
        if has and (kind in (SEI, SPS, PPS, AUD) or first):
            out.append((begin, last, key))
            begin, has, key = None, False, False
        begin = a if begin is None else begin
        has |= kind in (SLICE, IDR)
        key |= kind == IDR
        last = b
    return [*out, (begin, last, key)] if has else out


def h264_track(data: bytes, rate: int = 30) -> Track:
    """A raw stream's pictures as packets, one each tick of ``rate`` per second in file order."""
    units = h264_units(data)
    if not units:
        raise ValueError("no pictures in the stream")
    ticks = list(range(len(units)))
    return Track(([a for a, _, _ in units], [b - a for a, b, _ in units], ticks, ticks, [k for _, _, k in units]), rate, 0, 0, "h264", len(units), "h264")


def track(data: bytes) -> Track:
    """The video track of a file, by what it looks like."""
    if data[4:8] in (b"ftyp", b"moov", b"mdat", b"free", b"wide"):
        return mp4_track(data)
    if data[:4] == b"\0\0\0\1" or data[:3] == b"\0\0\1":
        return h264_track(data)
    raise ValueError("neither an MP4 file nor a raw H.264 stream")


def _box(name: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), name) + body


def muxed(samples: list[tuple[bytes, int, int, bool]], timescale: int, width: int = 0, height: int = 0, codec: bytes = b"avc1") -> bytes:
    """An MP4 file of (content, pts, dts, is_key) samples in decode order, all in one chunk."""
    n = len(samples)
    contents, pts, dts, key = zip(*samples) if samples else ((), (), (), ())
    sizes = [*map(len, contents)]
    steps = [*map(sub, dts[1:], dts)]
    steps.append(steps[-1] if steps else 1)
    full = lambda name, *parts: _box(name, bytes(4), *parts)
    table = lambda name, width, *numbers: full(name, struct.pack(f">I{len(numbers)}i", len(numbers) // width, *numbers))
    ones = lambda numbers: chain.from_iterable(zip(repeat(1), numbers))
    head = _box(b"ftyp", b"isom", bytes(4), b"isomavc1")
    mdat = _box(b"mdat", *contents)
    entry = _box(codec, bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HH", width, height), bytes(50))
    stbl = _box(
        b"stbl",
        full(b"stsd", struct.pack(">I", 1), entry),
        table(b"stts", 2, *ones(steps)),
        table(b"ctts", 2, *ones(map(sub, pts, dts))).replace(b"ctts\0", b"ctts\1", 1),
        table(b"stss", 1, *(i for i, k in enumerate(key, 1) if k)),
        table(b"stsc", 3, *((1, n, 1) if n else ())),
        full(b"stsz", struct.pack(f">II{n}I", 0, n, *sizes)),
        table(b"stco", 1, *((len(head) + 8,) if n else ())),
    )
    mdia = _box(b"mdia", full(b"mdhd", struct.pack(">IIIII", 0, 0, timescale, sum(steps), 0)), full(b"hdlr", bytes(4), b"vide", bytes(13)), _box(b"minf", stbl))
    return head + mdat + _box(b"moov", full(b"mvhd", bytes(96)), _box(b"trak", mdia))


def wrapped(data: bytes, rate: int = 30) -> bytes:
    """A raw H.264 stream as an MP4 file: NAL units with lengths instead of start codes."""
    samples = []
    for i, (a, b, key) in enumerate(h264_units(data)):
        units = [data[a + x - 3 : a + y - 3] for x, y in nal_units(b"\0\0\1" + data[a:b])]
        samples.append((b"".join(struct.pack(">I", len(u)) + u for u in units), i, i, key))
    return muxed(samples, rate)


PACKETS = "array<struct<pts:bigint,dts:bigint,pts_ns:bigint,offset:bigint,size:bigint,is_key:boolean>>"
#: Packets from which on those of a few files are handed on.
AT_ONCE = 1 << 14
METADATA = "struct<container:string,codec:string,width:int,height:int,timescale:bigint,num_frames:bigint,duration_s:double,framerate:double,bit_rate_bps:bigint>"


def described(data: bytes) -> tuple[tuple, tuple]:
    """Values of the metadata's fields, and pts, dts, offset, size and is_key of the packets in presentation order, ties in
    file order. Times in ns are rounded down."""
    t = track(data)
    offsets, sizes, pts, dts, key = t.columns
    n = len(pts)
    if not n:
        raise ValueError("the video track has no packets")
    if True not in key:
        raise ValueError("the video track has no key frames")
    if not t.timescale:
        raise ValueError("the video track has a timescale of 0")
    order = sorted(range(n), key=pts.__getitem__)
    first, last = (pts[i] * SECOND // t.timescale for i in (order[0], order[-1]))
    if max(-first, last, max(offsets)) > MOST:
        raise ValueError("times or places beyond 64 bits")
    span, seconds, size = (last - first) / 1e9, t.duration / t.timescale, sum(sizes)
    meta = (t.container, t.codec, t.width, t.height, t.timescale, n, seconds, n / seconds if seconds else 0.0, int(size * 8 / span) if span > 0 else 0)
    pick = itemgetter(*order) if n > 1 else tuple
    return meta, tuple(map(pick, (pts, dts, offsets, sizes, key)))


def indexed(files: DataFrame, content: str = "content") -> DataFrame:
    """``files`` with ``metadata``, ``packets`` and ``errors`` (map from step to message) instead of the content."""
    keep = [f for f in files.schema.fields if f.name != content]
    schema = T.StructType([*keep, *T.StructType.fromDDL(f"metadata {METADATA}, packets {PACKETS}, errors map<string,string>").fields])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(schema[n].dataType) for n in ("metadata", "packets", "errors")]
        nothing = (None,) * len(schema["metadata"].dataType.fields)
        fields = lambda kind: [kind.field(i) for i in range(kind.num_fields)]

        def columns(contents):
            """The three columns of the first files, as many as have ``AT_ONCE`` packets, which are laid end to end."""
            metas, errors, ends, flat = [], [], [0], ([], [], [], [], [])
            for data in contents:
                if ends[-1] >= AT_ONCE:
                    break
                try:
                    if not data.is_valid:
                        raise ValueError("no content")
                    meta, found = described(data.as_py())
                    for whole, own in zip(flat, found):
                        whole.extend(own)
                    metas.append(meta)
                    errors.append([])
                except (ValueError, KeyError, IndexError, struct.error) as e:  # a file that is no video is data here
                    metas.append(nothing)
                    errors.append([("probe", f"{type(e).__name__}: {e}")])
                ends.append(len(flat[0]))
            failed = pa.array([m is nothing for m in metas], pa.bool_())
            values = [pa.array(c, f.type) for c, f in zip(zip(*metas), fields(kinds[0]))]
            pts, scale = np.array(flat[0], np.int64), np.repeat(np.array([m[4] or 1 for m in metas], np.int64), np.diff(ends))
            ns = pts // scale * SECOND + pts % scale * SECOND // scale  # in parts, which 64 bits hold
            numbers = (pts, flat[1], ns, *flat[2:])
            packets = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(numbers, fields(kinds[1].value_type))], fields=fields(kinds[1].value_type))
            return [pa.StructArray.from_arrays(values, fields=fields(kinds[0]), mask=failed), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), packets, type=kinds[1], mask=failed), pa.array(errors, kinds[2])]

        for b in batches:
            while b.num_rows:
                made = columns(b.column(content))
                done = len(made[0])
                yield pa.RecordBatch.from_arrays([*(b.column(f.name).slice(0, done) for f in keep), *made], names=schema.names)
                b = b.slice(done)

    return files.select(*(f.name for f in keep), content).mapInArrow(run, schema)
