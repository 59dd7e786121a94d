"""Quality rules by distribution divergence.

A document's character-class histogram and common-word histogram are compared with those of reference languages by
Jensen-Shannon distance (base 2, so from 0 to 1). The references come from the corpus itself: a language is a value of
the language column that at least one in ``LEAST_SHARE`` documents has, so there are that many at most; its common
words are the ``COMMON`` commonest ones of its documents, and its histograms are the sums over them. Documents that fail
the base rules count in neither. Words are known by one of ``BUCKETS`` hash values, lower-cased in ASCII: rare words that
share a value with a common one add little to it.

A document is rejected if its nearest reference is farther than a threshold, for either histogram or for their sum. A
histogram is compared only if it counts enough (``MIN_CHARS``, ``MIN_WORDS``): short texts diverge by chance. A document
of a language without a reference is not compared, nor is any if there is no reference: then the base rules decide. One
of no language is compared with all references.

Three passes read the texts or what was counted in them: word counts by language, both histograms of every document
(written once to the shared checkpoint folder, so a lost executor costs its own tasks), and the verdicts. What reaches
the driver is a row for each reference language and common word.

Null and empty texts have no words and fail the base rule. Null ids stay null. Repeated rows are judged alike. An empty
table gives no rows. Columns other than id, text and language are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.text import MULTIPLIER, SEPARATORS, SpanHash, byte_view, filled, mix, per_row, slices, small_batches, words_of
from skein.session import checkpointed

#: Common words of a language, hash values that words have, and the share of documents that makes a language a reference.
COMMON = 24
BUCKETS = 1 << 14
LEAST_SHARE = 1000
#: Names of the character classes, in the order of the histogram.
CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "mark", "symbol", "latin", "other")
MIN_CHARS, MIN_WORDS = 200, 60
#: Largest distance to the nearest reference that passes.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.26, 0.36
#: Largest sum of both, where both histograms count enough.
MAX_SUM_DISTANCE = 0.52
MIN_BASE_WORDS = 50
MAX_REPEAT_PERCENT = 50


def class_table() -> np.ndarray:
    """The class of each byte; continuation bytes of UTF-8 get the number after the last class."""
    t = np.full(256, CLASSES.index("other"), np.uint8)
    t[ord("a") : ord("z") + 1] = 0
    t[ord("A") : ord("Z") + 1] = 1
    t[ord("0") : ord("9") + 1] = 2
    t[[9, 11, 12, 13, 32]] = 3
    t[10] = 4
    t[list(b".,;:?'\"()-")] = 5
    t[list(b"!/_@=+[]{}\\^~`")] = 6
    t[list(b"#*$%&|<>")] = 7
    t[0xC3:0xC6] = 8
    t[0x80:0xC0] = len(CLASSES)
    return t


CLASS_OF = class_table()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def word_buckets(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash value of each word."""
    return (SpanHash(LOWER[data])(start, end) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _repeated_lines(text: str) -> int:
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif line.strip(" \t\n\x0b\x0c\r"):
            seen.add(line)
    return n


def base_failed(n_words: np.ndarray, n_repeat: np.ndarray) -> np.ndarray:
    return (n_words < MIN_BASE_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)


def features(texts: pa.Array) -> dict[str, np.ndarray]:
    """The base counts and the character histogram of each text, by array work over all bytes of the texts.

    ``word_row`` and ``word_bucket``: the text and the hash value of each word.
    """
    data, off = byte_view(texts)
    n = len(off) - 1
    rows = np.repeat(np.arange(n), np.diff(off))
    kinds = CLASS_OF[data]
    chars = np.bincount(rows * (len(CLASSES) + 1) + kinds, minlength=n * (len(CLASSES) + 1)).reshape(n, -1)[:, :-1]
    start, end, word_row = words_of(data, off)
    n_words = per_row(word_row, n)
    word_chars = per_row(rows[~SEPARATORS[data] & (kinds != len(CLASSES))], n)
    hashes = SpanHash(data)(start, end)

    # words in three-word windows that the text has twice or more
    repeat = np.zeros(len(start), bool)
    if len(start) >= 3:
        three = mix(mix(hashes[:-2] + MULTIPLIER) + mix(hashes[1:-1] ^ MULTIPLIER) * np.uint64(3) + hashes[2:] * np.uint64(5))
        whole = word_row[:-2] == word_row[2:]
        key = mix(three + word_row[:-2].astype(np.uint64) * MULTIPLIER)
        at = np.flatnonzero(whole)
        order = at[np.argsort(key[at], kind="stable")]
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        begins = order[twice]
        for k in range(3):
            repeat[begins + k] = True
    n_repeat = per_row(word_row[repeat], n)

    lines = np.array([_repeated_lines(t) for t in filled(texts).to_pylist()], np.int64)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": chars[:, CLASSES.index("symbol")], "n_dup_lines": lines, "n_repeat_words": n_repeat, "chars": chars, "word_row": word_row, "word_bucket": word_buckets(data, start, end)}


def js_distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of each row's histogram to one reference; empty histograms are at 0."""
    total = counts.sum(1, keepdims=True)
    p = counts / np.maximum(total, 1)
    q = reference / reference.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip((left + right) / 2, 0, 1)), 0.0)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = "doc_id long, lang string, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, chars array<int>, words array<int>"


def common_words(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, list[int]]:
    """The commonest words' hash values of each reference language."""
    small_batches(docs.sparkSession)

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for piece in slices(batches, text):
            f = features(piece.column(text))
            names = piece.column(lang).to_pylist()
            good = ~base_failed(f["n_words"], f["n_repeat_words"])
            index = {g: i for i, g in enumerate(dict.fromkeys(names))}
            of = np.array([index[g] for g in names], np.int64)
            # One value more than there are words: the number of documents, failed ones too.
            rows = np.concatenate((of[f["word_row"]][good[f["word_row"]]] * (BUCKETS + 1) + f["word_bucket"][good[f["word_row"]]], of * (BUCKETS + 1) + BUCKETS))
            counts = np.bincount(rows, minlength=len(index) * (BUCKETS + 1)).reshape(len(index), -1)
            for g, i in index.items():
                sums[g] = sums[g] + counts[i] if g in sums else counts[i]
            if len(sums) > 64:  # many values are no languages; the sums then leave the task as they are
                yield from _sum_rows(sums)
                sums = {}
        yield from _sum_rows(sums)

    summed = docs.select(text, lang).mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    summed = checkpointed(summed)  # a row for each language and word value
    total = summed.filter(F.col("bucket") == BUCKETS).agg(F.sum("n")).first()[0] or 0
    often = summed.filter((F.col("bucket") == BUCKETS) & F.col("lang").isNotNull() & (F.col("n") * LEAST_SHARE >= total)).select("lang")
    words = summed.filter(F.col("bucket") < BUCKETS).join(F.broadcast(often), "lang")  # LEAST_SHARE rows at most
    top = words.groupBy("lang").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "bucket"))), 1, COMMON)["bucket"].alias("b"))  # BUCKETS entries at most
    return {r.lang: list(r.b) for r in top.orderBy("lang").collect()}


def _sum_rows(sums: dict[str, np.ndarray]):
    for g, n in sums.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([g] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["lang", "bucket", "n"])


def bins(common: dict[str, list[int]]) -> np.ndarray:
    """The bin of each hash value: one for each that is common in any language, the last one for all other words."""
    known = sorted({b for words in common.values() for b in words})
    table = np.full(BUCKETS, len(known), np.int64)
    table[known] = np.arange(len(known))
    return table


def extract(docs: DataFrame, common: dict[str, list[int]], doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Base counts and both histograms of every document."""
    small_batches(docs.sparkSession)
    table = bins(common)
    width = int(table.max(initial=0)) + 1

    def run(batches):
        for piece in slices(batches, text):
            f = features(piece.column(text))
            n = len(piece)
            words = np.bincount(f["word_row"] * width + table[f["word_bucket"]], minlength=n * width).reshape(n, width)
            lists = [pa.array(list(x.astype(np.int32)), pa.list_(pa.int32())) for x in (f["chars"], words)]
            failed = base_failed(f["n_words"], f["n_repeat_words"])
            yield pa.RecordBatch.from_arrays([piece.column(doc_id), piece.column(lang), *(pa.array(f[c], pa.int64()) for c in COUNTS), pa.array(failed), *lists], names=["doc_id", "lang", *COUNTS, "base_failed", "chars", "words"])

    return docs.select(doc_id, text, lang).mapInArrow(run, FEATURES)


def references(found: DataFrame, common: dict[str, list[int]]) -> dict[str, tuple[list[int], list[int]]]:
    """Summed histograms of the documents of each reference language that pass the base rules."""
    width = int(bins(common).max(initial=0)) + 1
    sums = [F.sum(F.col("chars")[i]).alias(f"c{i}") for i in range(len(CLASSES))]
    good = found.filter(~F.col("base_failed") & F.col("lang").isin(sorted(common)))
    chars = {r.lang: [r[f"c{i}"] for i in range(len(CLASSES))] for r in good.groupBy("lang").agg(*sums).collect()}  # a row a reference
    words = {g: [0] * width for g in chars}
    each = good.select("lang", F.posexplode("words").alias("i", "n")).groupBy("lang", "i").agg(F.sum("n").alias("n"))
    for r in each.collect():  # a row for each reference and common word
        words[r.lang][r.i] = r.n
    return {g: (chars[g], words[g]) for g in sorted(chars) if sum(chars[g]) and sum(words[g])}


def judge(found: DataFrame, refs: dict[str, tuple[list[int], list[int]]]) -> DataFrame:
    """Distances to the nearest reference and the verdict, by the counts of :func:`extract`."""
    small_batches(found.sparkSession)
    chars = [np.array(c, float) for c, _ in refs.values()]
    words = [np.array(w, float) for _, w in refs.values()]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            c = np.stack(b.column("chars").to_numpy(zero_copy_only=False)).astype(float)
            w = np.stack(b.column("words").to_numpy(zero_copy_only=False)).astype(float)
            far_c = np.min([js_distance(c, r) for r in chars], axis=0) if chars else np.zeros(len(c))
            far_w = np.min([js_distance(w, r) for r in words], axis=0) if words else np.zeros(len(c))
            failed = b.column("base_failed").to_numpy(zero_copy_only=False)
            few_c, few_w = c.sum(1) < MIN_CHARS, w.sum(1) < MIN_WORDS
            near = (few_c | (far_c <= MAX_CHAR_DISTANCE)) & (few_w | (far_w <= MAX_WORD_DISTANCE)) & (few_c | few_w | (far_c + far_w <= MAX_SUM_DISTANCE))
            unknown = np.array([g is not None and g not in refs for g in b.column("lang").to_pylist()], bool)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(b.column(k) for k in COUNTS), pa.array(failed), pa.array((near | unknown) & ~failed), pa.array(far_c), pa.array(far_w)], names=["doc_id", *COUNTS, "base_failed", "kept", "char_distance", "word_distance"])

    return found.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, char_distance double, word_distance double")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op2: base counts and the verdict by divergence for every whole document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    common = common_words(docs)
    found = checkpointed(extract(docs, common))
    return judge(found, references(found, common))
