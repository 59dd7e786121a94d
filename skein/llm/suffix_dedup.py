"""Exact repeats of ``LENGTH`` bytes by a sparse suffix array, range-partitioned by sampled splitters.

Not every suffix need be sorted. Of the k-mers (``KMER`` bytes) that a string of LENGTH bytes holds, the one of least
hash, leftmost among equals, is its anchor: equal strings have equal anchors at equal offsets, wherever they are. The
starts that share an anchor are neighbours; with the bytes that their strings cover they form a segment. Two strings
can be equal only if their segments' k-mers are.

1. One pass hashes k-mers and segments. Counts for each k-mer, combined before the shuffle, leave the segments whose
   k-mer occurs twice.
2. Of those each distinct segment goes, once and with its number of occurrences, with its bytes to the bucket of its
   anchor's suffix: Spark samples the suffixes' leading ``KMER`` bytes for splitters. A bucket sorts its suffixes by a
   multikey quicksort whose characters are eight bytes, and the reversed text left of the anchors alike, and takes the
   longest common prefixes of neighbours from the sorted order, within the bucket and across the edges of the blocks
   that it is compared in. It streams through in parts of about ``PART`` bytes, laid by the leading bytes. Splitters do
   not part suffixes that agree in the leading KMER bytes, so no pair of neighbours that matters lies across two buckets:
   every bucket also hands out its first and last suffix's leading bytes, and these are compared across the boundaries.
   A string repeats if its segment occurs twice, or another one has its class of left contexts and its class of right
   ones.
3. K-mers with over ``HOT`` distinct segments would fill a bucket; their strings are counted by a 128-bit digest
   instead, combined before the shuffle, which takes any number of them.

Spans of repeats are gathered for each document and cut where they are joined to its text.

Null texts read as empty. Repeated rows repeat each other; their segments are fetched and sorted once. Rows of one id with
different texts are told apart by a hash of the text. An empty table gives no rows. Columns other than id and text are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skein.llm.text import MULTIPLIER, SpanHash, byte_view, mix, slices, small_batches
from skein.session import checkpointed

LENGTH = 200
KMER = 80
WINDOW = LENGTH - KMER + 1
HOT = 50_000
#: Starts handled at once; a longer text is taken in pieces that overlap by LENGTH - 1 bytes.
PIECE = 1 << 21
#: Bytes of segments that are sorted at once; a bucket of more is taken in parts that end between two k-mers.
PART = 16 << 20
#: Rows of a bucket whose contexts are laid out as matrices at once.
ROWS = 8192


def anchors(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First start, number of starts and anchor's offset from the first of each segment.

    ``first``, ``last``: the starts of each text that has any, end exclusive, ascending.
    """
    if not len(first):
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    h = SpanHash(data)
    n = len(data) - KMER + 1
    kmers = mix((h.sums[KMER:] - h.sums[:n]) * h.down[:n])
    v = (kmers & np.uint64(0xFFFFFFFFFF000000)) | np.arange(n, dtype=np.uint64)
    size = 1
    while 2 * size <= WINDOW:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    if size < WINDOW:
        v = np.minimum(v[: len(v) - (WINDOW - size)], v[WINDOW - size :])
    at = (v & np.uint64(0xFFFFFF)).astype(np.int64)
    starts = np.concatenate([np.arange(a, b) for a, b in zip(first, last)]) if len(first) > 1 else np.arange(first[0], last[0])
    of = at[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (of[1:] != of[:-1]) | (starts[1:] != starts[:-1] + 1)
    edge = np.flatnonzero(new)
    return starts[edge], np.diff(np.append(edge, len(starts))), of[edge] - starts[edge]


def segments(data: np.ndarray, off: np.ndarray):
    """(row, start in the row, starts, anchor offset, k-mer hash, segment hash) of the segments of all texts."""
    out = []
    begin, end = off[:-1], off[1:] - LENGTH + 1
    rows = np.flatnonzero(end > begin)
    groups, size = [[]], 0
    for r in rows:  # pieces of about PIECE starts; a long text gives several
        for lo in range(begin[r], end[r], PIECE):
            hi = min(end[r], lo + PIECE)
            if size + hi - lo > PIECE and groups[-1]:
                groups.append([])
                size = 0
            groups[-1].append((r, lo, hi))
            size += hi - lo
    for g in groups:
        if not g:
            continue
        row, lo, hi = (np.array(x, np.int64) for x in zip(*g))
        base = lo[0]
        part = data[base : hi[-1] + LENGTH - 1]
        start, n, m = anchors(part, lo - base, hi - base)
        h = SpanHash(part)
        kmer = h(start + m, start + m + KMER)
        whole = mix(h(start, start + n - 1 + LENGTH) + (n * 256 + m).astype(np.uint64) * MULTIPLIER)
        which = row[np.searchsorted(lo - base, start, side="right") - 1]
        out.append((which, start + base - off[which], n, m, kmer, whole))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The row's own id, one that is never null, a hash that tells texts of one id apart, and the text."""
    return docs.select(F.col(doc_id).alias("doc"), F.coalesce(F.col(doc_id), F.xxhash64(text)).alias("id"), F.hash(text).alias("sub"), F.col(text).alias("text"))


def _found(texts: DataFrame) -> DataFrame:
    """A row for each segment; ``at`` packs its start, number of starts and anchor offset."""

    def run(batches):
        for piece in slices(batches, "text"):
            data, off = byte_view(piece.column("text"))
            row, start, n, m, kmer, whole = segments(data, off)
            take = pa.array(row)
            at = start << 16 | n << 8 | m
            yield pa.RecordBatch.from_arrays([pa.array(kmer.view(np.int64)), pa.array(whole.view(np.int64)), piece.column("id").take(take), piece.column("sub").take(take), pa.array(at)], names=["kmer", "whole", "id", "sub", "at"])

    return texts.mapInArrow(run, "kmer long, whole long, id long, sub int, at long")


def multikey_order(words: np.ndarray, lengths: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The order of rows by group, words from the left, then length: a multikey quicksort, all parts at once.

    A part is the rows of a group that agree in the words before its depth. Each round splits every part of two rows or
    more by a pivot of its own into those with a lesser, the same and a greater word there; those with the same go one
    word deeper. The length is the last word.
    """
    n, width = words.shape
    order = np.argsort(group, kind="stable")
    part = group[order]
    new = np.ones(n, bool)
    new[1:] = part[1:] != part[:-1]
    depth = np.zeros(n, np.int64)  # by place in the order
    while True:
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, n))
        open_ = np.flatnonzero((size > 1) & (depth[start] <= width))
        if not len(open_):
            return order
        which = np.repeat(np.arange(len(open_)), size[open_])
        at = np.repeat(start[open_] - np.cumsum(size[open_]) + size[open_], size[open_]) + np.arange(len(which))
        rows, deep = order[at], depth[at]
        value = np.where(deep < width, words[rows, np.minimum(deep, width - 1)], lengths[rows].astype(np.uint64))
        middle = np.cumsum(size[open_]) - size[open_] + size[open_] // 2
        pivot = value[middle][which]
        key = which * 3 + (value >= pivot) + (value > pivot)
        by = np.argsort(key, kind="stable")
        key = key[by]
        order[at] = rows[by]
        depth[at] = deep[by] + (key % 3 == 1)
        new[at[1:]] |= key[1:] != key[:-1]


def _matrix(data: np.ndarray, start: np.ndarray, length: np.ndarray, width: int, step: int) -> np.ndarray:
    """Bytes from each start on (step 1) or before it backwards (step -1), zeros after ``length``; whole words wide."""
    wide = -(-width // 8) * 8
    out = np.zeros((len(start), wide), np.uint8)
    columns = np.arange(width)
    for lo in range(0, len(start), ROWS):
        s, n = start[lo : lo + ROWS], length[lo : lo + ROWS]
        there = columns[None, :] < n[:, None]
        index = s[:, None] + step * columns[None, :] - (step < 0)
        out[lo : lo + ROWS, :width] = np.where(there, data[np.clip(index, 0, len(data) - 1)], 0)
    return out


def _sorted_prefixes(matrix: np.ndarray, length: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the rows and the common prefix of each with the one before it (-1: another group)."""
    order = multikey_order(matrix.view(">u8").astype(np.uint64), length, group)
    lcp = np.full(len(order), -1, np.int64)
    for lo in range(1, len(order), ROWS):
        a, b = order[lo - 1 : lo - 1 + min(ROWS, len(order) - lo)], order[lo : lo + ROWS]
        differ = matrix[a] != matrix[b]
        first = np.where(differ.any(1), differ.argmax(1), matrix.shape[1])
        lcp[lo : lo + ROWS] = np.where(group[a] == group[b], np.minimum(first, np.minimum(length[a], length[b])), -1)
    return order, lcp


def repeats(data: np.ndarray, off: np.ndarray, kmer: np.ndarray, n: np.ndarray, m: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
    """For each segment of a bucket the flags of its starts whose strings occur twice in all of the bucket.

    ``data``, ``off``: the segments' bytes. ``count``: occurrences of each segment.
    """
    anchor = off[:-1] + m
    right, left = np.minimum(off[1:] - anchor, LENGTH), m
    _, group = np.unique(kmer, return_inverse=True)
    r_order, r_lcp = _sorted_prefixes(_matrix(data, anchor, right, LENGTH, 1), right, group)
    l_order, l_lcp = _sorted_prefixes(_matrix(data, anchor, left, WINDOW - 1, -1), left, group)
    flags = [np.zeros(k, bool) for k in n]
    base = np.concatenate(([0], np.cumsum(n)))
    flat = np.zeros(base[-1], bool)
    r_class, l_class = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
    for a in range(WINDOW):  # bytes of the string that lie left of the anchor
        rows = np.flatnonzero((a <= m) & (a > m - n))
        if not len(rows):
            continue
        r_class[r_order] = np.cumsum(r_lcp < LENGTH - a)
        l_class[l_order] = np.cumsum(l_lcp < a)
        key = r_class[rows] * (len(n) + 1) + l_class[rows]
        order = np.argsort(key, kind="stable")
        new = np.ones(len(rows), bool)
        new[1:] = np.diff(key[order]) != 0
        which = np.cumsum(new) - 1
        often = np.bincount(which, count[rows][order])[which] > 1
        hit = rows[order][often]
        flat[base[hit] + m[hit] - a] = True
    for i in range(len(n)):
        flags[i] = flat[base[i] : base[i + 1]]
    return flags


def _runs(flags: np.ndarray) -> list[int]:
    """First and last + 1 of each run of flags, one after the other."""
    return np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0])))).tolist()


PIECES = "kmer long, whole long, n int, m int, count long, lead binary, bytes binary"


def _with_bytes(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted segments (kmer, whole, count, id, sub, at), and their anchors' leading bytes."""
    listed = wanted.groupBy("id", "sub").agg(F.collect_list(F.struct("kmer", "whole", "count", "at")).alias("want"))
    joined = texts.drop("doc").join(listed, ["id", "sub"]).dropDuplicates(["id", "sub"])  # already laid by both

    def run(batches):
        for piece in slices(batches, "text"):
            data, off = byte_view(piece.column("text"))
            lists = piece.column("want")
            sizes = np.diff(lists.offsets.to_numpy())
            of = np.repeat(off[:-1], sizes)
            kmer, whole, count, at = (lists.flatten().field(k).to_numpy() for k in range(4))
            start, n, m = of + (at >> 16), at >> 8 & 255, at & 255
            raw = data.tobytes()
            body = [raw[a:b] for a, b in zip(start.tolist(), (start + n - 1 + LENGTH).tolist())]
            lead = [raw[a : a + KMER] for a in (start + m).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(kmer), pa.array(whole), pa.array(n, pa.int32()), pa.array(m, pa.int32()), pa.array(count), pa.array(lead, pa.binary()), pa.array(body, pa.binary())], names=["kmer", "whole", "n", "m", "count", "lead", "bytes"])

    return joined.mapInArrow(run, PIECES)


RUNS = "kmer long, whole long, runs array<int>, edge array<binary>"


def _bucketed(pieces: DataFrame) -> DataFrame:
    """Runs of repeated starts of every segment, by buckets of the anchors' suffixes.

    A row with an ``edge`` is a bucket's first and last leading bytes, ``whole`` the bucket's number.
    """
    ranged = pieces.repartitionByRange("lead").sortWithinPartitions("lead").drop("lead")

    def found(t: pa.Table) -> Iterator[pa.RecordBatch]:
        t = t.combine_chunks()
        large = t["bytes"].cast(pa.large_binary()).combine_chunks()
        off = np.frombuffer(large.buffers()[1], np.int64)[large.offset : large.offset + len(large) + 1]
        data = np.frombuffer(large.buffers()[2], np.uint8)[off[0] : off[-1]]
        kmer, n, m, count = (t[c].to_numpy().astype(np.int64) for c in ("kmer", "n", "m", "count"))
        flags = repeats(data, off - off[0], kmer, n, m, count)
        runs = pa.array([_runs(f) for f in flags], pa.list_(pa.int32()))
        yield from pa.table([t["kmer"], t["whole"], runs, pa.nulls(len(t), pa.list_(pa.binary()))], names=["kmer", "whole", "runs", "edge"]).to_batches(max_chunksize=4096)

    def lead(b: pa.RecordBatch, i: int) -> bytes:
        at = b.column("m")[i].as_py()
        return b.column("bytes")[i].as_py()[at : at + KMER]

    def run(batches):
        held, size, edge = [], 0, []
        for b in batches:
            if not b.num_rows:
                continue
            edge = [edge[0] if edge else lead(b, 0), lead(b, b.num_rows - 1)]
            held.append(b)
            size += b.nbytes
            if size >= PART:
                t = pa.Table.from_batches(held)
                kmer = t["kmer"].to_numpy()
                if len(other := np.flatnonzero(kmer != kmer[-1])):
                    cut = int(other[-1]) + 1
                    yield from found(t.slice(0, cut))
                    t = t.slice(cut)
                held, size = t.to_batches(), t.nbytes
        if held:
            yield from found(pa.Table.from_batches(held))
            bucket = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([bucket]), pa.nulls(1, pa.list_(pa.int32())), pa.array([edge], pa.list_(pa.binary()))], names=["kmer", "whole", "runs", "edge"])

    return ranged.mapInArrow(run, RUNS)


def compare_boundaries(runs: DataFrame) -> None:
    """Error if the last suffix of a bucket and the first of the next one agree in their leading bytes."""
    edges = runs.filter("edge is not null")  # a row for each bucket
    both = edges.select(F.col("edge")[1].alias("last"), F.lead(F.col("edge")[0]).over(W.orderBy("whole")).alias("next"))
    if not both.filter(F.col("last") == F.col("next")).isEmpty():
        raise RuntimeError("a splitter parts suffixes that agree in their leading bytes")


def _counted(pieces: DataFrame) -> DataFrame:
    """The same as :func:`_bucketed` by counting a digest of each string, for k-mers with very many segments."""

    def explode(batches):
        for b in batches:
            for kmer, whole, n, count, body in zip(*(b.column(c).to_pylist() for c in ("kmer", "whole", "n", "count", "bytes"))):
                keys = [hashlib.blake2b(body[j : j + LENGTH], digest_size=16).digest() for j in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([kmer] * n), pa.array([whole] * n), pa.array(range(n), pa.int32()), pa.array([count] * n), pa.array(keys, pa.binary())], names=["kmer", "whole", "j", "count", "key"])

    each = pieces.mapInArrow(explode, "kmer long, whole long, j int, count long, key binary")
    often = each.groupBy("key").agg(F.sum("count").alias("total")).filter("total > 1").select("key")
    hits = each.join(often, "key").groupBy("kmer", "whole").agg(F.array_sort(F.collect_set("j")).alias("js"))
    return hits.select("kmer", "whole", F.flatten(F.transform("js", lambda j: F.array(j, j + 1))).alias("runs"))


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, sub and spans (array of [start, end) in bytes, unmerged) of the texts that hold repeats."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = keyed(docs, doc_id, text)
    found = _found(texts)
    often = found.groupBy("kmer").agg(F.count("*").alias("total")).filter("total > 1").select("kmer")
    often = checkpointed(often)  # so that both sides of the join are shuffled for it and a hot k-mer's share is split
    known = checkpointed(found.join(often, "kmer"))
    place = F.min(F.struct("id", "sub", "at"))
    once = checkpointed(known.groupBy("kmer", "whole").agg(place.alias("p"), F.count("*").alias("count")).select("kmer", "whole", "p.*", "count"))
    hot = once.groupBy("kmer").agg(F.count("*").alias("k")).filter(F.col("k") > HOT).select("kmer")
    if hot.isEmpty():
        runs = _bucketed(_with_bytes(texts, once))
    else:
        runs = _bucketed(_with_bytes(texts, once.join(hot, "kmer", "left_anti"))).unionByName(_counted(_with_bytes(texts, once.join(hot, "kmer"))), allowMissingColumns=True)
    runs = checkpointed(runs)  # the texts' shuffle for it goes before that for the cut
    compare_boundaries(runs)
    start = F.shiftright("at", 16).cast("long")
    pairs = F.sequence(F.lit(0), (F.size("runs") / 2).cast("int") - 1)
    each = known.join(runs.filter(F.size("runs") > 0), ["kmer", "whole"]).select("id", "sub", "at", "runs", F.explode(pairs).alias("k"))
    part = each.select("id", "sub", (start + F.get("runs", 2 * F.col("k"))).alias("a"), (start + F.get("runs", 2 * F.col("k") + 1) - 1 + LENGTH).alias("b"))
    once = part.repartition("id", "sub").distinct()  # laid once for both steps; repeated rows give equal spans
    return once.groupBy("id", "sub").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the spans (rows of start, end) cover; touching spans are one."""
    if not len(spans):
        return []
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.concatenate(([True], spans[1:, 0] > ends[:-1])))
    return list(zip(spans[new, 0].tolist(), ends[np.append(new[1:] - 1, len(ends) - 1)].tolist()))


def cut_out(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, the maximal repeated spans and the bytes that remain, for every row."""
    small_batches(docs.sparkSession)
    spans = repeated_spans(docs, doc_id, text)
    joined = keyed(docs, doc_id, text).join(spans, ["id", "sub"], "left").select("doc", "text", "spans")

    def run(batches):
        for piece in slices(batches, "text"):
            data, off = byte_view(piece.column("text"))
            raw, out = data.tobytes(), []
            lists = piece.column("spans")
            for i in range(len(piece)):
                body = raw[off[i] : off[i + 1]]
                own = lists[i].values if lists[i].is_valid else None
                cut = merged(np.stack([own.field(0).to_numpy(), own.field(1).to_numpy()], 1)) if own is not None else []
                at, kept = 0, []
                for a, b in cut:
                    kept.append(body[at:a])
                    at = b
                kept.append(body[at:])
                out.append((len(body), [{"start": a, "end": b} for a, b in cut], b"".join(kept)))
            n, s, k = zip(*out)
            yield pa.RecordBatch.from_arrays([piece.column("doc"), pa.array(n, pa.int64()), pa.array(s, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(k, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op5: repeats of 200 bytes cut out of every whole document, by digest."""
    made = cut_out(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda x, s: x + s["end"] - s["start"])
    return made.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
