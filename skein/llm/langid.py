"""Language identification by error-correcting output codes.

Each language has a codeword of +-1 bits; a binary classifier over hashed byte n-grams predicts each bit. A classifier
is a linear one: the smoothed log-odds of an n-gram between the languages with and without the bit, averaged over the
text's n-grams, then calibrated by a logistic fit of slope and offset. That fit, and how far each bit is trusted, come
from a fourth of the sample that the log-odds of this step have not seen; the final log-odds are of all of it. Decoding
adds up each bit's logistic loss against every codeword, bits weighted by their trust, and takes the codeword of least
loss. The score is the softmax of the losses; ``ambiguous`` tells that the runner-up is within ``MARGIN``.

The fit takes about ``TRAIN_ROWS`` labelled documents, those whose hashed id is below a bound, so it does not depend on
the order or partitioning of the rows. Their texts are read once; n-gram counts are summed by the executors, and the
driver gets a row for each language and occupied bucket of the sample, which so bounds the languages too, and at most
twice ``TRAIN_ROWS`` rows of margins.

Null texts and texts without a letter are ``und`` with score 0. Repeated rows get equal predictions. With no row to
learn from every text is ``und``. An empty table gives no rows. Ties between codewords go to the earlier language.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.text import byte_view, slices, small_batches
from skein.session import checkpointed

TRAIN_ROWS = 8000
BUCKETS = 1 << 14
SIZES = (2, 3)
MARGIN = 0.1
UNKNOWN = "und"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def codewords(n: int, bits: int | None = None, seed: int = 7) -> np.ndarray:
    """A row of +-1 bits for each of n languages: every split of few languages, else random ones far apart.

    Up to five languages get the exhaustive code of 2**(n-1) - 1 bits (distance 2**(n-2)). More get ``bits`` columns,
    the best of up to 200 draws by the least distance between rows.
    """
    if n == 1:
        return np.ones((1, 1), np.int8)
    if n <= 5 and bits is None:
        columns = np.arange(1, 1 << (n - 1))
        return np.array([[1] * len(columns), *([1 if c >> i & 1 == 0 else -1 for c in columns] for i in range(n - 1))], np.int8)
    bits = bits or 4 * int(np.ceil(np.log2(n))) + 7
    rng, best, far = np.random.default_rng(seed), None, -1
    for _ in range(max(2, min(200, 4_000_000 // n**2))):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        code[:, np.abs(code.sum(0)) == n] *= np.where(np.arange(n) % 2, 1, -1)[:, None].astype(np.int8)
        wide = code.astype(np.float32)
        agree = wide @ wide.T
        np.fill_diagonal(agree, -bits)
        least = int(bits - agree.max()) // 2
        if least > far:
            best, far = code, least
    return best


def grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every n-gram of lower-cased bytes, within one text; digits count as one byte value."""
    low = LOWER[data]
    low[(low >= ord("0")) & (low <= ord("9"))] = ord("0")
    rows = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(off))
    buckets, of = [], []
    wide = low.astype(np.uint32)
    for n in SIZES:
        if len(data) < n:
            continue
        code = np.full(len(data) - n + 1, n, np.uint32)
        for k in range(n):
            code = code << np.uint32(8) | wide[k : len(data) - n + 1 + k]
        code *= np.uint32(0x9E3779B1)
        inside = rows[: len(code)] == rows[n - 1 :]
        buckets.append((code >> np.uint32(18))[inside].astype(np.int32))
        of.append(rows[: len(code)][inside])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(buckets), np.concatenate(of)


class Model:
    """Languages, codewords, bit weights by bucket, calibration and trust in each bit."""

    def __init__(self, languages: list[str], counts: dict[str, np.ndarray]) -> None:
        """``counts``: n-grams by bucket of each language; one without any has no say."""
        self.languages = sorted(languages)
        self.code = codewords(max(1, len(self.languages)))
        bits = self.code.shape[1]
        self.slope, self.offset, self.trust = np.ones(bits), np.zeros(bits), np.ones(bits)
        with_bit, without = (np.full((BUCKETS, bits), 1e-12) for _ in range(2))
        for code, g in zip(self.code, self.languages):
            if g in counts and len(self.languages) > 1:
                share = (counts[g] + 0.5) / (counts[g].sum() + 0.5 * BUCKETS)
                with_bit += share[:, None] * (code > 0)
                without += share[:, None] * (code < 0)
        has = np.array([g in counts for g in self.languages], bool)
        sizes = [np.maximum((self.code[has] * sign > 0).sum(0), 1) for sign in (1, -1)] if len(has) else [1, 1]
        self.weights = np.log((with_bit / sizes[0]) / (without / sizes[1])).astype(np.float32)

    def margins(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Mean log-odds of every text's n-grams, a column for each bit; texts without n-grams have zeros."""
        n = len(off) - 1
        bucket, row = grams(data, off)
        total = np.bincount(row, minlength=n)
        out = np.zeros((n, self.weights.shape[1]))
        for b in range(out.shape[1]):
            out[:, b] = np.bincount(row, self.weights[:, b][bucket], minlength=n)
        return out / np.maximum(total, 1)[:, None]

    def calibrate(self, margins: np.ndarray, languages: list[str]) -> None:
        """Slope and offset of each bit by Newton steps on the logistic loss, and trust by its accuracy."""
        at = {g: i for i, g in enumerate(self.languages)}
        truth = self.code[[at[g] for g in languages]].astype(float)
        for b in range(self.code.shape[1]):
            x = np.stack([margins[:, b], np.ones(len(margins))], 1)
            y, w = (truth[:, b] + 1) / 2, np.array([1.0, 0.0])
            for _ in range(12):
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
                w = w - np.linalg.solve(h, x.T @ (p - y) + 1e-3 * w)
            self.slope[b], self.offset[b] = w
            right = ((x @ w > 0) == (y > 0.5)).mean()
            self.trust[b] = np.log(max(right, 0.51) / max(1 - right, 1e-3))

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and ambiguity of each row of margins."""
        m = np.clip(margins * self.slope + self.offset, -30, 30)
        loss = np.stack([(self.trust * np.log1p(np.exp(-m * c))).sum(1) for c in self.code.astype(float)], 1) / self.trust.sum()
        p = np.exp(-(loss - loss.min(1, keepdims=True)) * self.code.shape[1])
        p /= p.sum(1, keepdims=True)
        ranked = np.sort(loss, 1)
        close = ranked[:, 1] - ranked[:, 0] < MARGIN if loss.shape[1] > 1 else np.zeros(len(loss), bool)
        best = loss.argmin(1)
        return best, p[np.arange(len(best)), best], close


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS) -> Model:
    """A model of about ``rows`` rows of ``docs``, which are the rows to learn from; null labels are left out.

    Rows of null ids have one hash like all others of one id; rows that repeat a sampled id all count.
    """
    labelled = docs.filter(F.col(lang).isNotNull())
    n = labelled.count()
    part, parts = F.pmod(F.xxhash64(doc_id), F.lit(1 << 40)), 1 << 40
    chosen = labelled.filter(part < (parts if n <= rows else int(parts * rows / n)))
    sample = checkpointed(chosen.select(F.col(text).alias("text"), F.col(lang).alias("lang"), (part % 4 == 0).alias("later")).filter("text is not null"))
    names = sorted(r[0] for r in sample.select("lang").distinct().collect())  # no more than the sample has rows
    at = {g: i for i, g in enumerate(names)}

    def count(batches):
        for piece in slices(batches, "text"):
            bucket, row = grams(*byte_view(piece.column("text")))
            langs = np.array([at[g] for g in piece.column("lang").to_pylist()], np.int64)
            later = piece.column("later").to_numpy(zero_copy_only=False).astype(np.int64)
            key, times = np.unique((langs[row] * 2 + later[row]) * BUCKETS + bucket, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(times.astype(np.int64))], names=["key", "n"])

    small_batches(docs.sparkSession)
    summed = sample.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()  # at most two a language and bucket of the sample
    key, times = summed["key"].to_numpy(), summed["n"].to_numpy()
    bucket, later, of = key % BUCKETS, key // BUCKETS % 2, key // BUCKETS // 2

    def counts(chosen: np.ndarray) -> dict[str, np.ndarray]:
        by = np.argsort(of[chosen], kind="stable")
        b, w, g = bucket[chosen][by], times[chosen][by], of[chosen][by]
        edge = np.searchsorted(g, np.arange(len(names) + 1))
        return {name: np.bincount(b[x:y], w[x:y], minlength=BUCKETS) for name, x, y in zip(names, edge, edge[1:]) if y > x}

    model = Model(names, counts(np.ones(len(of), bool)))
    if len(names) > 1:
        seen = Model(names, counts(later == 0))

        def margins(batches):
            for piece in slices(batches, "text"):
                m = seen.margins(*byte_view(piece.column("text")))
                yield pa.RecordBatch.from_arrays([piece.column("lang"), pa.array(list(m), pa.list_(pa.float64()))], names=["lang", "m"])

        made = sample.filter("later").mapInArrow(margins, "lang string, m array<double>").limit(2 * rows).toPandas()
        if len(made):
            model.calibrate(np.stack(made.m.to_list()), made.lang.to_list())
    return model


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Language, score and ambiguity of every whole text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x bits x buckets, whatever the corpus

    def run(batches):
        own = shared.value
        names = np.array([*own.languages, UNKNOWN], object)
        for piece in slices(batches, text):
            texts = piece.column(text)
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            if own.languages:
                best, score, close = own.decode(own.margins(*byte_view(texts)))
            else:
                best, score, close = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.zeros(len(texts), bool)
                letters = np.zeros(len(texts), bool)
            yield pa.RecordBatch.from_arrays([piece.column(doc_id), pa.array(names[np.where(letters, best, len(names) - 1)], pa.string()), pa.array(np.where(letters, score, 0.0)), pa.array(close & letters)], names=["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select(doc_id, text).mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op3: fit on the rows that are not held out, then predict every whole document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))  # a null id is not held out
    made = predict(docs, fit(docs.filter(~held)))
    return made.withColumn("held_out", held).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")
