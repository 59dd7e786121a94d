"""Secret scans that look under encodings: a worklist of decoded layers, each rescanned, until nothing new decodes.

The first layer is the text itself. Every layer is scanned for secrets and decoded further in two ways. Percent and
backslash-x bytes, backslash-u escapes (with braces too) and character references are replaced where they stand, so that
what is around them stays beside them; of a run of bytes that is no UTF-8 the parts that are one are replaced. Base64
runs are decoded. A run goes on over single line breaks, indented, quoted by ``>`` or written as backslash-n too, and as
a path, a prefix or a word may be glued to what was encoded, it is decoded from each of its first four characters: any
start agrees with one of those. All readable stretches of the bytes, as UTF-8 or as ASCII in UTF-16 of either order,
and those of the zlib and gzip streams that begin anywhere in them, become layers of their own.
Each character of a replaced layer keeps the span of the *original text* that it came from. A layer of its own has the
span of its run or, in a run of many lines, of the lines that it takes at least half of and those that a find is in. So
a find in any depth maps back to characters of the text. A layer seen before is not scanned again: this ends cycles,
and as every other decoding step shortens its input, but for decompression, the worklist empties.

A compressed layer of more than ``MAX_LAYER`` bytes is read in overlapping windows and counted in ``overflows``. What
is not followed from one window to the next is a compressed stream in such a layer that is itself, as bytes or base64,
longer than a window.

Null texts read as empty and have no finds; null ids stay null; repeated rows give repeated results; an empty table
gives none; other columns pass through ``scan``, where a name of its own among them is an error. Ties between finds are ordered by start, then kind, then end.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skein.llm.text import filled, slices, small_batches

# The three base patterns with the least length of what they must match, in this order of kinds.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex")
#: Strings of which a text must hold one, in lower case, before the assign pattern can match.
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
BACKSLASH_X = re.compile(r"(?:\\x[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}")
REFERENCE = re.compile(r"&(?:#[xX][0-9A-Fa-f]{1,6}|#[0-9]{1,7}|amp|quot|apos|lt|gt|nbsp|equals|colon);")
#: What stands between the lines of a run.
BREAK = re.compile(r"(?:\r\n?|\n)[ \t>]{0,16}|\\r\\n|\\n")
#: A line of 16 characters, or any one that another follows, and all lines after it.
BASE64 = re.compile(rf"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{{16,}}+|[A-Za-z0-9+/_-]++(?=(?:{BREAK.pattern})[A-Za-z0-9+/_-]))(?:(?:{BREAK.pattern})[A-Za-z0-9+/_-]++)*+={{0,2}}")
LEAST_RUN = 16
URL_SAFE = str.maketrans("-_", "+/")
#: UTF-8 without control characters; no secret and no code of one has fewer bytes or a control character but line breaks.
READABLE = re.compile(rb"(?:[\t\n\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|\xed[\x80-\x9f][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){14,}+")
#: The same for ASCII in UTF-16, low byte or high byte first.
WIDE = ((re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){14,}+"), "utf-16-le"), (re.compile(rb"(?:\x00[\t\n\r\x20-\x7e]){14,}+"), "utf-16-be"))
#: The first bytes of gzip streams and of zlib streams without a preset dictionary.
HEADER = re.compile(b"|".join([rb"\x1f\x8b\x08", *(re.escape(bytes([a, b])) for a in range(0x08, 0x80, 0x10) for b in range(256) if (a * 256 + b) % 31 == 0 and not b & 0x20)]), re.DOTALL)
#: Bytes that go to a decompressor at once; they give 4 MB at most.
STEP = 4096
MAX_LAYER = 64 << 20
OVERLAP = 1 << 16
SPACES = re.compile(rb" {1024,}+")
#: What base64 in lines, percent codes, backslash codes and character references are made of.
CODE_BYTES = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=%\\{}&#;> \t\r\n"


class Find(NamedTuple):
    start: int
    order: int
    end: int
    depth: int

    def show(self) -> str:
        return f"{KINDS[self.order]}:{self.start}:{self.end}"


def base_finds(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of each base match, by start, then kind; offsets in code points."""
    found = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _inflate(data: bytes, at: int) -> Iterator[tuple[bytes, int, bool]]:
    """(output, place in the data, whether the stream is over there) of the zlib or gzip stream that begins at a place.

    The members of a gzip stream are one output. What comes out before an error or an early end counts.
    """
    bits = 31 if data[at] == 0x1F else 15
    machine = zlib.decompressobj(bits)
    while at < len(data):
        step, saved = data[at : at + STEP], machine.copy()
        try:
            out = machine.decompress(step)
        except zlib.error:
            for k in range(len(step)):
                try:
                    out = saved.decompress(step[k : k + 1])
                except zlib.error:
                    return
                yield out, at + k + 1, False
            return
        at += len(step) - len(machine.unused_data)
        over = machine.eof and not (bits == 31 and data.startswith(b"\x1f\x8b\x08", at))
        yield out, at, over
        if over:
            return
        if machine.eof:
            machine = zlib.decompressobj(bits)


def _windows(data: bytes, at: int) -> Iterator[bytes]:
    """The output of the stream that begins at a place, in windows of about MAX_LAYER bytes.

    What a stream holds has one span, so a window need only find what there is: the next one begins with the last
    ``OVERLAP`` bytes, or with all of a code that has not ended if that is longer and shorter than a window. Long runs of
    spaces, which the assign pattern may cross, are shortened.
    """
    parts, size = [], 0
    for out, _, _ in _inflate(data, at):
        parts.append(out)
        size += len(out)
        if size < MAX_LAYER + OVERLAP:
            continue
        held = SPACES.sub(b" ", b"".join(parts))
        if len(held) > MAX_LAYER:
            yield held
            code = len(held) - len(held.rstrip(CODE_BYTES))
            held = held[-(code if OVERLAP < code < MAX_LAYER else OVERLAP) :]
        parts, size = [held], len(held)
    yield b"".join(parts)


def _readable(data: bytes) -> Iterator[tuple[str, int, int]]:
    """(text, start, end) of the readable stretches of bytes."""
    for m in READABLE.finditer(data):
        yield m[0].decode(), m.start(), m.end()
    if b"\0" in data:
        for pattern, code in WIDE:
            for m in pattern.finditer(data):
                yield m[0].decode(code), m.start(), m.end()


def _texts(data: bytes) -> Iterator[tuple[str, int, int, bool]]:
    """(text, start, end, whether a layer passed MAX_LAYER) of what is readable in the bytes and in streams in them."""
    for text, start, end in _readable(data):
        yield text, start, end, False
    for start, end, long in _streams(data):
        if long:
            yield "", start, end, True
        seen, work = set(), [_windows(data, start)]
        while work:
            if (part := next(work[-1], None)) is None:
                work.pop()
            elif (key := hashlib.blake2b(part, digest_size=16).digest()) not in seen:  # a stream may hold itself
                seen.add(key)
                for text, _, _ in _readable(part):
                    yield text, start, end, False
                for at, _, long in _streams(part):
                    if long:
                        yield "", start, end, True
                    work.append(_windows(part, at))


def _streams(data: bytes) -> Iterator[tuple[int, int, bool]]:
    """Start, end and whether more than MAX_LAYER bytes come out, of each zlib or gzip stream that gives any."""
    at = 0
    while h := HEADER.search(data, at):
        at, size, end, over = h.start() + 1, 0, h.start(), False
        for out, end, over in _inflate(data, h.start()):
            size += len(out)
        if over:
            at = end
        if size:
            yield h.start(), end, size > MAX_LAYER


class Layer(NamedTuple):
    """A decoded text. ``starts`` and ``ends``: where each character comes from; ``span``: what any find takes in besides.

    With a span alone all of the text comes from there, with none of the three it is the original text. A ``guess`` begins
    inside a run: what it finds may be a part of what another layer finds whole.
    """

    text: str
    depth: int
    span: tuple[int, int] | None = None
    starts: list[int] | None = None
    ends: list[int] | None = None
    guess: bool = False

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return self.span or (start, end)
        a, b = self.starts[start], self.ends[end - 1]
        return (min(a, self.span[0]), max(b, self.span[1])) if self.span else (a, b)


def _coded_bytes(code: str, data: bytes) -> list[tuple[int, str]]:
    """(length of code, text) parts of a run of coded bytes: characters, and as they are the codes of bytes that are in none."""
    width, out, at = len(code) // len(data), [], 0
    for c in data.decode("utf-8", "surrogateescape"):
        n = width if "\udc80" <= c <= "\udcff" else width * len(c.encode())
        out.append((n, code[at : at + n] if "\udc80" <= c <= "\udcff" else c))
        at += n
    return out


def _percent(code: str) -> list[tuple[int, str]]:
    return _coded_bytes(code, bytes.fromhex(code.replace("%", "")))


def _backslash_x(code: str) -> list[tuple[int, str]]:
    return _coded_bytes(code, bytes.fromhex(code.replace("\\x", "")))


def _escape(code: str) -> list[tuple[int, str]]:
    if code[1] == "u" and code[2] != "{":
        return [(len(code), bytes.fromhex(code[2:6] + code[8:12]).decode("utf-16-be", "replace"))]
    point = int(code[2:].strip("{}"), 16)
    return [(len(code), chr(point) if point < 0x110000 and not 0xD800 <= point < 0xE000 else "\ufffd")]


def _reference(code: str) -> list[tuple[int, str]]:
    return [(len(code), html.unescape(code))]


#: What is replaced in place: a string that the layer must hold, the pattern and the parts of a match.
IN_PLACE = (("%", PERCENT, _percent), ("\\x", BACKSLASH_X, _backslash_x), ("\\", ESCAPE, _escape), ("&", REFERENCE, _reference))


def _replaced(layer: Layer, pattern: re.Pattern, parts) -> Layer | None:
    """The layer with what the pattern finds decoded in place; None if nothing changes."""
    out, starts, ends, at = [], [], [], 0
    tracked = layer.span is None or layer.starts is not None

    def keep(lo: int, hi: int) -> None:
        out.append(layer.text[lo:hi])
        if tracked:
            starts.extend(range(lo, hi) if layer.starts is None else layer.starts[lo:hi])
            ends.extend(range(lo + 1, hi + 1) if layer.ends is None else layer.ends[lo:hi])

    for m in pattern.finditer(layer.text):
        keep(at, m.start())
        at = m.start()
        for n, t in parts(m[0]):
            out.append(t)
            if tracked:
                a, b = layer.origin(at, at + n)
                starts.extend([a] * len(t))
                ends.extend([b] * len(t))
            at += n
    if not at:
        return None
    keep(at, len(layer.text))
    text = "".join(out)
    return None if text == layer.text else Layer(text, layer.depth + 1, layer.span, starts if tracked else None, ends if tracked else None, layer.guess)


class Run:
    """A base64 run of a layer: its lines' places there, and their characters joined."""

    def __init__(self, layer: Layer, m: re.Match) -> None:
        self.layer = layer
        breaks = [x.span() for x in BREAK.finditer(layer.text, *m.span())]
        last = m.end() - len(m[0]) + len(m[0].rstrip("="))
        self.places = list(zip([m.start(), *(b for _, b in breaks)], [*(a for a, _ in breaks), last]))
        self.chars = "".join([layer.text[a:b] for a, b in self.places]).translate(URL_SAFE)
        self.at = [0]
        for a, b in self.places:
            self.at.append(self.at[-1] + b - a)
        self.places[-1] = self.places[-1][0], m.end()

    def data(self, phase: int) -> bytes:
        """The bytes of the characters from ``phase`` on."""
        n = len(self.chars) - phase
        body = self.chars[phase : len(self.chars) - (n % 4 == 1)]
        return base64.b64decode(body + "=" * (-len(body) % 4))

    def lines(self, phase: int, start: int, end: int) -> tuple[int, int, int, int]:
        """First and last character, and first and last line, that bytes come from."""
        a, b = phase + start // 3 * 4, min(phase + -(-end // 3) * 4, len(self.chars))
        return a, b, bisect_right(self.at, a) - 1, bisect_left(self.at, b) - 1

    def origin(self, first: int, last: int) -> tuple[int, int]:
        return self.layer.origin(self.places[first][0], self.places[last][1])

    def made(self, text: str, phase: int, start: int, end: int) -> Layer:
        """The layer of a text that these bytes hold, as they are or in a stream."""
        depth, guess = self.layer.depth + 1, self.layer.guess or phase + start > 0
        a, b, first, last = self.lines(phase, start, end)
        if first == last or len(text.encode()) != end - start:
            return Layer(text, depth, self.origin(first, last), guess=guess)
        starts, ends, at = [], [], start
        for c in text:
            n = len(c.encode())
            _, _, x, y = self.lines(phase, at, at + n)
            starts.append(self.origin(x, x)[0])
            ends.append(self.origin(y, y)[1])
            at += n
        lo = first + (2 * (self.at[first + 1] - a) < self.at[first + 1] - self.at[first])
        hi = last - (2 * (b - self.at[last]) < self.at[last + 1] - self.at[last])
        return Layer(text, depth, self.origin(lo, hi) if lo <= hi else None, starts, ends, guess)


def _inner(layer: Layer) -> Iterator[tuple[Layer, bool]]:
    """The layers that a layer decodes to, and for each whether it stands for a stream of more than MAX_LAYER bytes."""
    for hint, pattern, parts in IN_PLACE:
        if hint in layer.text and (made := _replaced(layer, pattern, parts)):
            yield made, False
    for m in BASE64.finditer(layer.text):
        if m.end() - m.start() < LEAST_RUN:
            continue
        run = Run(layer, m)
        for phase in range(4):
            for text, start, end, cut in _texts(run.data(phase)):
                yield run.made(text, phase, start, end), cut


def finds(text: str) -> tuple[list[Find], int]:
    """Every find of a text, base ones in depth 0, and the number of layers longer than MAX_LAYER.

    A find below the first layer has the span of the original characters that it was decoded from. One of a guess goes if
    another decoded one of its kind spans it.
    """
    base = base_finds(text)
    found = {Find(s, k, e, 0) for s, k, e in base}
    known = {(s, k, e) for s, k, e in base}
    sure: set[tuple[int, int, int]] = set()
    overflows = 0
    seen: set[tuple] = set()
    work = [_inner(Layer(text, 0))]
    while work:
        if (made := next(work[-1], None)) is None:
            work.pop()
            continue
        layer, cut = made
        overflows += cut
        ends = layer.starts and (layer.starts[0], layer.ends[-1])
        key = (layer.span, ends, layer.guess, hashlib.blake2b(layer.text.encode("utf-8", "replace"), digest_size=16).digest())
        if key in seen:
            continue
        seen.add(key)
        for a, kind, b in base_finds(layer.text):
            start, end = layer.origin(a, b)
            if not layer.guess:
                sure.add((start, kind, end))
            if (start, kind, end) not in known:
                known.add((start, kind, end))
                found.add(Find(start, kind, end, layer.depth))
        work.append(_inner(layer))
    widest = [-1, -1, -1]
    for f in sorted(found, key=lambda f: (f.start, -f.end)):
        if f.depth and f.end <= widest[f.order] and (f.start, f.order, f.end) not in sure:
            found.remove(f)
        elif f.depth:
            widest[f.order] = max(widest[f.order], f.end)
    return sorted(found), overflows


def redacted(text: str, spans: list[Find]) -> str:
    """The text with every found span, overlapping ones joined, replaced by ``[SECRET]``."""
    parts, at = [], 0
    joined: list[list[int]] = []
    for f in sorted(spans):
        if joined and f.start < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], f.end)
        else:
            joined.append([f.start, f.end])
    for start, end in joined:
        parts += [text[at:start], "[SECRET]"]
        at = end
    return "".join([*parts, text[at:]])


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("depth", T.IntegerType())]))


def scan(docs: DataFrame, text: str = "text", spans: str = "secret_spans", clean: str = "redacted") -> DataFrame:
    """``docs`` with the spans of all finds and the redacted text (null for a null text)."""
    if clash := {spans.lower(), clean.lower()} & {c.lower() for c in docs.columns}:
        raise ValueError(f"the input has columns named {sorted(clash)}")
    small_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField(spans, SPAN), T.StructField(clean, T.StringType())])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("depth", pa.int32())]))

    def run(batches):
        for piece in slices(batches, text):
            texts = piece.column(text).to_pylist()
            found = [finds(t)[0] if t else [] for t in texts]
            rows = [[{"kind": KINDS[f.order], "start": f.start, "end": f.end, "depth": f.depth} for f in fs] for fs in found]
            cleaned = [redacted(t, fs) if fs else t for t, fs in zip(texts, found)]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(rows, kind), pa.array(cleaned, pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)


def _digest(text: str) -> tuple:
    found, overflows = finds(text)
    base = [f for f in found if f.depth == 0]
    counts = [sum(f.order == k for f in base) for k in range(3)]
    sha = hashlib.sha256(",".join(f.show() for f in base).encode()).hexdigest()
    return *counts, sha, ",".join(f.show() for f in found), len(found) - len(base), overflows


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op10: base finds, and the finds that decoding adds, of every whole document."""
    small_batches(spark)
    fields = [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_decoded", pa.int64()), ("n_overflows", pa.int64())]

    def run(batches):
        for piece in slices(batches, "text"):
            rows = list(zip(*map(_digest, filled(piece.column("text")).to_pylist())))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *(pa.array(v, t) for v, (_, t) in zip(rows, fields[1:]))], names=[n for n, _ in fields])

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return docs.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_decoded long, n_overflows long")
