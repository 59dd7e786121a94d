"""A quality classifier by nearest-neighbour voting in a latent-semantic space.

Terms are of three kinds: hashed byte trigrams of the text with letters folded to their case class (layout and symbols,
in any language alike), hashed lower-cased words (what it is about), and marks of repetition (a word equal to the one
before, a word seen before in the text). A document is its log-scaled, idf-weighted term vector of unit length,
projected on the leading singular vectors of the labelled sample. Every document is compared exactly, by blocked matrix
products, with all broadcast labelled vectors; the labels of the nearest ``NEIGHBOURS`` vote with their cosine to the
power ``SHARPNESS``.

The labelled sample holds at most ``PER_LABEL`` rows of each label, those with the least hash of their id; the rarer
label so gets as many votes as the other. It bounds the broadcast (``2 * PER_LABEL * RANK`` floats and the projection) and what
the driver collects (``2 * PER_LABEL * TERMS``), whatever the corpus.

Null texts read as empty. A text without terms gets the share of label 1. Null ids are scored too. Repeated rows get equal
scores; of several texts of a labelled id the greatest is learned from. Null labels are left out; equal labels of a
document count once, unlike ones both. With no labels every score is 0.5. An empty table gives no rows. Columns other
than those named are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.text import SpanHash, byte_view, slices, small_batches, words_of
from skein.session import checkpointed

PER_LABEL = 1500
TERMS = 1 << 11
RANK = 32
NEIGHBOURS = 15
SHARPNESS = 32
THRESHOLD = 0.3
#: Terms kept for marks of repetition, ahead of the hashed trigrams; words have the other half of the terms.
MARKS = 2
WORDS = TERMS // 2
BLOCK = 1024


def fold_table() -> np.ndarray:
    """Byte values with all lower-case letters (any other script's bytes too), capitals and digits folded together."""
    t = np.arange(256, dtype=np.uint32)
    t[ord("a") : ord("z") + 1] = ord("a")
    t[0x80:] = ord("a")
    t[ord("A") : ord("Z") + 1] = ord("A")
    t[ord("0") : ord("9") + 1] = ord("0")
    t[[9, 11, 12, 13]] = 32
    return t


FOLD = fold_table()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def term_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Occurrences of each term, a row for each text."""
    n = len(off) - 1
    rows = np.repeat(np.arange(n, dtype=np.int64), np.diff(off))
    out = np.zeros(n * TERMS, np.int64)
    if len(data) >= 3:
        f = FOLD[data]
        code = (f[:-2] << np.uint32(16) | f[1:-1] << np.uint32(8) | f[2:]) * np.uint32(0x9E3779B1)
        inside = rows[:-2] == rows[2:]
        bucket = (code >> np.uint32(8)) % np.uint32(TERMS - WORDS - MARKS) + np.uint32(MARKS)
        out += np.bincount(rows[:-2][inside] * TERMS + bucket[inside], minlength=n * TERMS)
    start, end, row = words_of(data, off)
    if len(start):
        word = (SpanHash(LOWER[data])(start, end) >> np.uint64(20)).astype(np.int64) % WORDS
        out += np.bincount(row * TERMS + TERMS - WORDS + word, minlength=n * TERMS)
        h = SpanHash(data)(start, end)
        again = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
        out += np.bincount(row[1:][again] * TERMS, minlength=n * TERMS)
        order = np.lexsort((h, row))
        seen = (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])
        out += np.bincount(row[order][1:][seen] * TERMS + 1, minlength=n * TERMS)
    return out.reshape(n, TERMS)


class Model:
    """Projection, labelled vectors and their labels; ``prior`` is the share of label 1."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, prior: float) -> None:
        self.prior, self.labels = prior, labels.astype(np.float32)
        self.vectors = None
        if not len(labels):
            return
        seen = (counts > 0).sum(0)
        self.idf = np.log((1 + len(counts)) / (1 + seen)).astype(np.float32) + 1
        weighted = self._weighted(counts)
        gram = weighted.T.astype(np.float64) @ weighted
        _, basis = np.linalg.eigh(gram)
        self.basis = basis[:, ::-1][:, :RANK].astype(np.float32)
        self.vectors = self._unit(weighted @ self.basis)

    def _weighted(self, counts: np.ndarray) -> np.ndarray:
        size = np.maximum(counts.sum(1, keepdims=True), 1)
        return self._unit(np.log1p(counts * (1000.0 / size)).astype(np.float32) * self.idf)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The weighted vote on each text, from exact cosines with all labelled vectors."""
        n = len(off) - 1
        out = np.full(n, self.prior)
        if self.vectors is None:
            return out
        k = min(NEIGHBOURS, len(self.vectors))
        for lo in range(0, n, BLOCK):
            hi = min(n, lo + BLOCK)
            counts = term_counts(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
            cosine = self._unit(self._weighted(counts) @ self.basis) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 0) ** SHARPNESS + 1e-9
            vote = (weight * self.labels[near]).sum(1) / weight.sum(1)
            out[lo:hi] = np.where(counts.sum(1) > 0, np.clip(vote, 0, 1), self.prior)
        return out


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", per_label: int = PER_LABEL) -> Model:
    """A model of at most ``per_label`` rows of ``labels`` for each of the labels 0 and 1."""
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(doc_id, F.col(label).cast("int").alias("y")).distinct()
    total = {r.y: r.n for r in usable.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not total:
        return Model(np.zeros((0, TERMS)), np.zeros(0), 0.5)
    prior = total.get(1, 0) / sum(total.values())
    parts = [usable.filter(F.col("y") == y).orderBy(F.xxhash64(doc_id), doc_id).limit(per_label) for y in sorted(total)]
    chosen = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
    chosen = checkpointed(chosen.select(F.col(doc_id).alias("id"), "y"))  # at most two rows for each of per_label
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen.select("id").distinct()), "id")
    sample = texts.groupBy("id").agg(F.max("text").alias("text")).join(F.broadcast(chosen), "id")
    small_batches(docs.sparkSession)

    def run(batches):
        for piece in slices(batches, "text"):
            counts = term_counts(*byte_view(piece.column("text")))
            packed = [c.astype(np.int32).tobytes() for c in counts]
            yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("y"), pa.array(packed, pa.binary())], names=["id", "y", "c"])

    rows = sorted(sample.mapInArrow(run, "id long, y int, c binary").collect())
    counts = np.array([np.frombuffer(r.c, np.int32) for r in rows]).reshape(len(rows), TERMS)
    return Model(counts, np.array([r.y for r in rows]), prior)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, score and predicted label of every whole text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by PER_LABEL, RANK and TERMS

    def run(batches):
        for piece in slices(batches, text):
            s = shared.value.score(*byte_view(piece.column(text)))
            yield pa.RecordBatch.from_arrays([piece.column(doc_id), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(doc_id, text).mapInArrow(run, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold; no join is needed."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for piece in slices(batches, text):
            yield piece.filter(pa.array(shared.value.score(*byte_view(piece.column(text))) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def learned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    """The model of the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return fit(docs, labels.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))


def op4_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op4: a quality score of every whole document, learned from the labels that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    made = score(docs, learned(spark, docs, sf_dir))
    return made.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"), "score", "predicted")
