"""Substring dedup by content-defined chunks.

A gear hash (h = 2h + G[byte] modulo 2**16, so it depends on the last 16 bytes only) rolls over every text; a chunk ends
where the top ``MASK_BITS`` bits are zero, the next byte begins a character and no other such place is less than
``MIN_CHUNK`` bytes before. All of this is local, so an insertion moves no cut that is more than a few bytes away.
Stretches without a cut are split every ``MAX_CHUNK`` bytes. A chunk is known by the 64-bit digest of its bytes.

The document with the least id keeps a chunk; in all others it is a copy, and so is a later one in the same document.
Runs of neighbouring copies of ``MIN_RUN`` bytes or more are cut out: chunks are small, so that a passage is found up to
a few bytes from its ends, but a shorter run is phrases and no passage. A chance agreement of digests therefore does
nothing unless its neighbours agree too.

Only (digest, id) pairs, one for each chunk and document, are shuffled: counts and least ids are combined before the
shuffle, so a chunk that a third of the corpus shares sends one row a task; the join back to the pairs is one that
adaptive execution splits. The copies of a document are gathered by its id as a set, no more than the different chunks
of the texts with that id, and its text is cut where they are joined to it, with the chunks computed again from the text.

Null texts stay null and have no chunks; empty ones have none. Rows of one id and text (repeated rows) are one place
and keep the same bytes; rows with a null id are never copies of others. Chunks of equal digests of texts with one id
are ordered by place. An empty table gives no rows. Clashing column names are no problem: the operator's own columns
are renamed away from the input's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.text import BYTE_CODES, SpanHash, byte_view, slices, small_batches
from skein.session import checkpointed

WINDOW = 16
MASK_BITS = 4
MIN_CHUNK, MAX_CHUNK = 12, 512
MIN_RUN = 128
GEAR = (BYTE_CODES >> np.uint64(48)).astype(np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, by doubling the number of bytes summed."""
    h = GEAR[data]
    for k in (1, 2, 4, 8):
        h[k:] = h[k:] + (h[:-k] << np.uint16(k))
    return h


def chunks(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each chunk; the chunks of a text cover it."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    good = gear(data) >> np.uint16(16 - MASK_BITS) == 0
    good[:-1] &= (data[1:] & 0xC0) != 0x80
    at = np.flatnonzero(good) + 1
    row = np.searchsorted(off, at, side="left") - 1
    inside = (at - off[row] >= WINDOW) & (at < off[row + 1])
    at, row = at[inside], row[inside]
    apart = np.ones(len(at), bool)
    apart[1:] = (np.diff(at) >= MIN_CHUNK) | (np.diff(row) > 0)
    begins = off[:-1][np.diff(off) > 0]
    starts = np.union1d(begins, at[apart])
    ends = np.append(starts[1:], len(data))
    long = np.flatnonzero(ends - starts > MAX_CHUNK)
    if len(long):
        more = np.concatenate([np.arange(starts[i] + MAX_CHUNK, ends[i], MAX_CHUNK) for i in long])
        for _ in range(3):  # back to the beginning of a character
            more -= (data[more] & 0xC0) == 0x80
        starts = np.union1d(starts, more)
        ends = np.append(starts[1:], len(data))
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def _pairs(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(digest, id) of the chunks of every document, repeats in a document once."""
    small_batches(docs.sparkSession)

    def run(batches):
        for piece in slices(batches, text):
            data, off = byte_view(piece.column(text))
            start, end, row = chunks(data, off)
            digest = SpanHash(data)(start, end).view(np.int64)
            order = np.lexsort((digest, row))
            first = np.ones(len(order), bool)
            first[1:] = (np.diff(digest[order]) != 0) | (np.diff(row[order]) != 0)
            order = order[first]
            yield pa.RecordBatch.from_arrays([pa.array(digest[order]), piece.column(doc_id).take(pa.array(row[order]))], names=["digest", "id"])

    return docs.select(doc_id, text).mapInArrow(run, "digest long, id long")


def copied_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document that shares chunks: ``id`` and the chunks as (digest, least id that has it)."""
    pairs = _pairs(docs.filter(F.col(doc_id).isNotNull()), doc_id, text)
    shared = pairs.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most").select("digest", "least")
    shared = checkpointed(shared)  # so that both sides of the join are shuffled for it and a hot chunk's share is split
    # Laid by id once for both steps; the first one leaves a repeated row's chunks once.
    once = pairs.join(shared, "digest").repartition("id").groupBy("id", "digest").agg(F.min("least").alias("least"))
    return once.groupBy("id").agg(F.collect_list(F.struct("digest", "least")).alias("copies"))


STATS = "n_bytes long, n_chunks long, n_removed long, n_spans long, n_shared long, first_ids array<long>"


def removed_spans(data: np.ndarray, later: np.ndarray, shared: np.ndarray, min_run: int = MIN_RUN) -> tuple[list[tuple[int, int]], np.ndarray, int, int]:
    """Spans of one text to cut, the digests cut, the number of chunks and the bytes in shared chunks.

    ``later``: digests that another document keeps. ``shared``: digests of chunks found in several documents.
    """
    start, end, _ = chunks(data, np.array([0, len(data)]))
    digest = SpanHash(data)(start, end).view(np.int64)
    again = np.ones(len(digest), bool)
    again[np.unique(digest, return_index=True)[1]] = False
    copy = again | np.isin(digest, later)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], copy.view(np.int8), [0]))))
    spans, gone = [], np.zeros(len(digest), bool)
    for a, b in zip(edge[::2], edge[1::2]):
        if end[b - 1] - start[a] >= min_run:
            spans.append((int(start[a]), int(end[b - 1])))
            gone[a:b] = True
    return spans, digest[gone], len(start), int((end - start)[np.isin(digest, shared)].sum())


def _free(docs: DataFrame, name: str) -> str:
    """The name, longer by underscores as long as the input has such a column."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", stats: bool = True, min_run: int = MIN_RUN) -> DataFrame:
    """``docs`` with copies cut out of ``text``; with ``stats`` also a struct ``chunk_dedup`` of what was done."""
    if stats and "chunk_dedup" in {c.lower() for c in docs.columns}:
        raise ValueError("the input has a column named chunk_dedup")
    schema = T.StructType([*docs.schema.fields, *([T.StructField("chunk_dedup", T.StructType.fromDDL(STATS))] if stats else [])])
    own_id, own_copies = (_free(docs, name) for name in ("__id", "__copies"))
    lists = copied_chunks(docs, doc_id, text).select(F.col("id").alias(own_id), F.col("copies").alias(own_copies))
    joined = docs.join(lists, F.col(doc_id) == F.col(own_id), "left").drop(own_id)
    small_batches(docs.sparkSession)
    place = docs.columns.index(text)
    kind = pa.struct([("n_bytes", pa.int64()), ("n_chunks", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("n_shared", pa.int64()), ("first_ids", pa.list_(pa.int64()))])

    def run(batches):
        for piece in slices(batches, text):
            ids, copies = piece.column(doc_id).to_pylist(), piece.column(own_copies)
            data, off = byte_view(piece.column(text))
            texts, notes = [], []
            for i, (d, known) in enumerate(zip(ids, piece.column(text).is_valid().to_pylist())):
                own = data[off[i] : off[i + 1]]
                listed = copies[i].values if copies[i].is_valid else None
                digests = listed.field(0).to_numpy() if listed is not None else np.zeros(0, np.int64)
                least = listed.field(1).to_numpy() if listed is not None else np.zeros(0, np.int64)
                later = least < d if listed is not None else np.zeros(0, bool)
                spans, cut, n, shared = removed_spans(own, digests[later], digests, min_run)
                kept = bytearray()
                at = 0
                for a, b in spans:
                    kept += own[at:a].tobytes()
                    at = b
                kept += own[at:].tobytes()
                texts.append(kept.decode() if known else None)
                first = np.unique(least[later & np.isin(digests, cut)]).tolist()
                notes.append({"n_bytes": len(own), "n_chunks": n, "n_removed": len(own) - len(kept), "n_spans": len(spans), "n_shared": shared, "first_ids": first})
            columns = [c for c, name in zip(piece.columns, piece.schema.names) if name != own_copies]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(notes, kind)] if stats else [])], names=schema.names)

    return joined.mapInArrow(run, schema)


def op9_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document after the dedup of its chunks: sizes, spans, digest of what stays and whose copies went."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    made = dedup(docs)
    s = F.col("chunk_dedup")
    return made.select("doc_id", s.n_bytes.alias("n_bytes"), s.n_chunks.alias("n_chunks"), s.n_removed.alias("n_removed"), s.n_spans.alias("n_spans"), s.n_shared.alias("n_shared"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"), s.first_ids.alias("first_doc_ids"))
