"""Queries on the edges of the engine: streams, kernels, archives, comparisons of runs, and whole programs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import ids
from skein.operators import grouping, kernels, routing, spans, summary
from skein.plans.tables import joined, table
from skein.session import shared_folder
from skein.sources import sinks
from skein.streaming import arrivals


def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events as a stream, counted in windows of a day every 12 hours by type, drained and read back."""
    schema = table(spark, d, "events").schema
    stream = arrivals.arriving(spark, f"{d}/events.parquet*", schema).withColumn("ts", F.col("ts").cast("timestamp"))
    counted = arrivals.window_counts(stream, "ts", "24 hours", "12 hours", "event_type")
    made = arrivals.drained(counted, shared_folder(spark, "run"), "windows")
    return made.select(F.unix_micros("start").alias("start"), "event_type", "n_rows")


HALF = 43_200_000_000
STREAM_SQL = f"""SELECT ((epoch_us(ts) // {HALF}) - i) * {HALF} AS start, event_type, count(*) AS n_rows FROM events, generate_series(0, 1) AS g(i) GROUP BY ALL"""


def event_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of a user: runs of events less than 36 hours apart."""
    ev = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    made = arrivals.sessions(ev, "ts", "36 hours", "user_id")
    return made.select("user_id", F.unix_micros("first").alias("first"), F.unix_micros("last").alias("last"), "n_rows")


SESSIONS_SQL = """WITH e AS (SELECT user_id, epoch_us(ts) AS t, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events),
g AS (SELECT user_id, t, sum(CASE WHEN gap IS NULL OR gap >= 129600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t RANGE UNBOUNDED PRECEDING) AS s FROM e)
SELECT user_id, min(t) AS first, max(t) AS last, count(*) AS n_rows FROM g GROUP BY user_id, s"""


def kernel_embedding(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings of a deterministic kernel for every document, which fails on some languages: rows stay, with the error."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    made = kernels.with_kernel(docs, kernels.HashEmbedding("text", 8, refuses=("lang", "fr")), batch_rows=1)
    return made.select("doc_id", joined(F.transform("embedding", lambda x: ((x + 1) * 128).cast("int"))).alias("embedding"), F.col("kernel_error").alias("error"))


EMBEDDING_SQL = """SELECT doc_id, CASE WHEN lang <> 'fr' THEN array_to_string(list_transform(range(8), lambda i: ('0x' || sha256(text)[2 * i + 1 : 2 * i + 2])::INT), ',') END AS embedding,
  CASE WHEN lang = 'fr' THEN 'ValueError: no fr' END AS error FROM documents"""


def stage_compare(spark: SparkSession, d: str) -> DataFrame:
    """Fields in which two runs over the parts differ: prices moved within and beyond the tolerance, rows missing."""
    left = table(spark, d, "part")
    moved = F.col("p_retailprice") + F.when(F.col("p_partkey") % 10 == 0, 0.5).otherwise(0.001)
    right = left.filter("p_partkey % 7 <> 0").withColumn("p_retailprice", moved).withColumn("p_size", F.when(F.col("p_partkey") % 3 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")))
    return kernels.compared(left, right, "p_partkey", 0.01)


COMPARE_SQL = """SELECT '_row' AS field, count(*) AS n_rows, count(*) FILTER (p_partkey % 7 = 0) AS n_different FROM part
UNION ALL SELECT 'p_size', count(*), count(*) FILTER (p_partkey % 7 <> 0 AND p_partkey % 3 = 0) FROM part
UNION ALL SELECT 'p_retailprice', count(*), count(*) FILTER (p_partkey % 7 <> 0 AND p_partkey % 10 = 0) FROM part
UNION ALL SELECT f, n, 0 FROM (SELECT count(*) AS n FROM part) t, (VALUES ('p_name'), ('p_brand'), ('p_type')) v(f)"""


def shard_archives(spark: SparkSession, d: str) -> DataFrame:
    """Documents of each source as tars of about 20,000 characters: keys and bytes of each archive."""
    docs = table(spark, d, "documents").select("source", "doc_id", "text", "n_chars")
    grouped = grouping.packed(docs.drop("text"), "source", ["doc_id"], "n_chars", 20_000).join(docs.select("doc_id", "text"), "doc_id")
    path = F.concat_ws("/", "source", ids.part_path(F.floor(F.col("group_no") / 3)), ids.tar_path(F.col("group_no") % 3))
    rows = grouped.select(path.alias("path"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), F.encode("text", "utf-8").alias("data"))
    return sinks.archives(rows, "path", "name", "data").select("path", "n_keys", F.octet_length("content").cast("long").alias("n_bytes"))


ARCHIVE_SQL = """WITH RECURSIVE o AS (SELECT source, doc_id, text, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
p AS (SELECT source, rn, text, n_chars AS so_far, 0 AS g FROM o WHERE rn = 1
  UNION ALL SELECT o.source, o.rn, o.text, CASE WHEN p.so_far + o.n_chars > 20000 THEN o.n_chars ELSE p.so_far + o.n_chars END, p.g + CASE WHEN p.so_far + o.n_chars > 20000 THEN 1 ELSE 0 END
  FROM p JOIN o ON o.source = p.source AND o.rn = p.rn + 1)
SELECT source || '/part_' || lpad((g // 3)::VARCHAR, 6, '0') || '/' || lpad((g % 3)::VARCHAR, 6, '0') || '.tar' AS path, count(*) AS n_keys,
  (ceil((sum(512 + ceil(strlen(text) / 512.0) * 512) + 1024) / 10240.0) * 10240)::BIGINT AS n_bytes FROM p GROUP BY source, g"""


def split_program(spark: SparkSession, d: str) -> DataFrame:
    """A whole split: plan what is unfinished, cut, score, route, window, roll up to kept and rejected by source."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    planned = docs.join(labels.filter("toxic = 1").select("doc_id"), "doc_id", "left_anti")
    clips = planned.select("doc_id", "source", "lang", F.posexplode(spans.fixed_stride(F.lit(0.0), F.col("n_chars") / 100.0, 10.0, 10.0, 2.0)).alias("clip_idx", "s"))
    clips = clips.withColumn("frames", F.round((F.col("s.end") - F.col("s.start")) * 30).cast("long"))
    clips = routing.reject(clips, routing.motion(F.col("frames").cast("double"), F.lit(1.0), 100.0, 0.5), "motion")
    clips = routing.reject(clips, F.col("lang") != "en", "language")
    windows = F.size(spans.caption_windows(F.col("frames"), 128, 64))
    rolled = clips.groupBy("source").agg(F.count("*").alias("n_clips"), F.count_if(F.col("stage_rejected").isNull()).alias("n_kept"), F.count_if(F.col("stage_rejected") == "motion").alias("n_motion"), F.count_if(F.col("stage_rejected") == "language").alias("n_language"), F.sum(F.when(F.col("stage_rejected").isNull(), windows).otherwise(0)).alias("n_windows"))
    return rolled


SPLIT_SQL = """WITH c AS (SELECT source, lang, round((least(i * 10.0::DOUBLE + 10.0, n_chars / 100.0::DOUBLE) - i * 10.0::DOUBLE) * 30)::BIGINT AS f
  FROM documents d, generate_series(0, 100000) AS g(i) WHERE i * 10.0 < n_chars / 100.0::DOUBLE AND least(i * 10.0::DOUBLE + 10.0, n_chars / 100.0::DOUBLE) - i * 10.0::DOUBLE >= 2.0
  AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1)),
r AS (SELECT source, f, CASE WHEN f < 100 THEN 'motion' WHEN lang <> 'en' THEN 'language' END AS why FROM c)
SELECT source, count(*) AS n_clips, count(*) FILTER (why IS NULL) AS n_kept, count(*) FILTER (why = 'motion') AS n_motion, count(*) FILTER (why = 'language') AS n_language,
  sum(CASE WHEN why IS NULL THEN CASE WHEN f < 4 THEN 0 WHEN f <= 128 THEN 1 ELSE f // 128 + CASE WHEN f % 128 >= 64 THEN 1 ELSE 0 END END ELSE 0 END)::BIGINT AS n_windows FROM r GROUP BY source"""


def image_summary(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents as images: the counts, and every rejected one's id, from slices of their hash."""
    rows = table(spark, d, "labels").select("doc_id", (F.col("quality") == 1).alias("ok"))
    made = summary.outcome_lists(rows, "doc_id", "ok")
    counts = made.agg(F.sum("n").alias("all"), F.sum("n_passed").alias("passed")).select(F.inline(F.array(F.struct(F.lit("all").alias("what"), F.col("all").alias("n")), F.struct(F.lit("passed").alias("what"), F.col("passed").alias("n")))))
    return counts.unionByName(made.select(F.lit("rejected").alias("what"), F.explode("rejected").alias("n")))


IMAGE_SQL = """SELECT 'all' AS what, count(*) AS n FROM labels UNION ALL SELECT 'passed', count(*) FILTER (quality = 1) FROM labels UNION ALL SELECT 'rejected', doc_id FROM labels WHERE quality <> 1"""

QUERIES = {f.__name__: f for f in (stream_windows, event_sessions, kernel_embedding, stage_compare, shard_archives, split_program, image_summary)}
ORACLES = {
    "stream_windows": STREAM_SQL,
    "event_sessions": SESSIONS_SQL,
    "kernel_embedding": EMBEDDING_SQL,
    "stage_compare": COMPARE_SQL,
    "shard_archives": ARCHIVE_SQL,
    "split_program": SPLIT_SQL,
    "image_summary": IMAGE_SQL,
}
