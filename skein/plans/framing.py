"""Queries on frames, cameras and model answers, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import text
from skein.operators import frames, spans
from skein.plans.tables import joined, micros, table


def _ms(spark: SparkSession, d: str, *more: str) -> DataFrame:
    return table(spark, d, "events").select("user_id", F.floor(micros("ts") / 1000).alias("ms"), *more)


def clip_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Clips of two cameras for each document, chunked by the primary's whole seconds: 3 clips of 8 s a chunk."""
    docs = table(spark, d, "documents").select("doc_id", (F.col("n_chars") / 100.0).alias("s"))
    clips = docs.select("doc_id", F.posexplode(spans.fixed_stride(F.lit(0.0), F.col("s"), 10.0, 10.0, 2.0)).alias("idx", "c"))
    clips = clips.select("doc_id", F.col("idx").cast("long").alias("idx"), F.col("c.start").alias("a"), F.col("c.end").alias("z"), F.explode(F.array(F.lit(0), F.lit(1))).alias("cam"))
    made = frames.chunked_by_seconds(clips, "doc_id", "cam", "idx", "a", "z", 3)
    return made.groupBy("doc_id", "cam", "chunk_index", "n_chunks").agg(F.count("*").alias("n_clips"), F.min("idx").alias("first"))


CHUNKS_SQL = """WITH RECURSIVE c AS (SELECT doc_id, i AS idx, floor(least(i * 10.0::DOUBLE + 10.0, n_chars / 100.0::DOUBLE) - i * 10.0::DOUBLE)::BIGINT AS s
  FROM documents, generate_series(0, 100000) AS g(i) WHERE i * 10.0 < n_chars / 100.0::DOUBLE AND least(i * 10.0::DOUBLE + 10.0, n_chars / 100.0::DOUBLE) - i * 10.0::DOUBLE >= 2.0),
p AS (SELECT doc_id, idx, s AS so_far, 0::BIGINT AS g FROM c WHERE idx = 0
  UNION ALL SELECT c.doc_id, c.idx, CASE WHEN so_far >= 24 THEN s ELSE so_far + s END, g + CASE WHEN so_far >= 24 THEN 1 ELSE 0 END FROM p JOIN c ON c.doc_id = p.doc_id AND c.idx = p.idx + 1),
m AS (SELECT *, max(g) OVER (PARTITION BY doc_id) + 1 AS n FROM p)
SELECT doc_id, cam::INT AS cam, g AS chunk_index, n AS n_chunks, count(*) AS n_clips, min(idx) AS first FROM m, (VALUES (0), (1)) v(cam) GROUP BY ALL"""


def frame_sampling(spark: SparkSession, d: str) -> DataFrame:
    """Frames of a user (seconds of the distinct hours with events) nearest to one point each two days."""
    hours = _ms(spark, d).select("user_id", (F.floor(F.col("ms") / 3_600_000) * 3600.0).alias("t")).distinct()
    times = hours.groupBy("user_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    return times.select("user_id", F.inline(frames.sampled(F.col("ts"), 1 / 172_800.0))).select("user_id", F.col("idx").cast("long").alias("idx"), F.col("n").cast("long").alias("n"))


SAMPLING_SQL = """WITH h AS (SELECT DISTINCT user_id, (epoch_ms(ts) // 3600000) * 3600.0::DOUBLE AS t FROM events), r AS (SELECT user_id, t, row_number() OVER (PARTITION BY user_id ORDER BY t) - 1 AS i FROM h),
b AS (SELECT user_id, min(t) AS lo, max(t) AS hi FROM h GROUP BY user_id), p AS (SELECT user_id, k, lo + k * 172800.0::DOUBLE AS p FROM b, generate_series(0, 5000) AS g(k) WHERE k * 172800.0::DOUBLE < hi - lo + 86400.0 OR k = 0),
n AS (SELECT p.user_id, k, arg_min(i, (abs(t - p), i)) AS idx FROM p JOIN r ON r.user_id = p.user_id GROUP BY p.user_id, k)
SELECT user_id, idx, count(*) AS n FROM n GROUP BY user_id, idx"""


def frame_regularity(spark: SparkSession, d: str) -> DataFrame:
    """Whether the distinct hours of each user flow evenly at one in twenty."""
    hours = _ms(spark, d).select("user_id", F.floor(F.col("ms") / 3_600_000).alias("t")).distinct()
    times = hours.groupBy("user_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    whole = F.element_at("ts", -1) - F.col("ts")[0]
    return times.select("user_id", frames.regular(F.col("ts"), F.lit(50.0), whole, whole / 1000.0).alias("even"))


REGULAR_SQL = """WITH h AS (SELECT DISTINCT user_id, epoch_ms(ts) // 3600000 AS t FROM events), g AS (SELECT user_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) AS gap FROM h)
SELECT user_id, coalesce(max(gap) <= 40 AND min(gap) >= 10, false) AS even FROM g GROUP BY user_id"""


def camera_strides(spark: SparkSession, d: str) -> DataFrame:
    """Users as sessions with two event types as cameras: aligned clips of 3 frames, a stride of 5 days."""
    hours = _ms(spark, d, "event_type").filter(F.col("event_type").isin("click", "view")).select("user_id", "event_type", F.floor(F.col("ms") / 3_600_000).alias("t")).distinct()
    cams = hours.groupBy("user_id", "event_type").agg(F.array_sort(F.collect_list("t")).alias("ts")).withColumn("fps", F.lit(500.0 / 12))
    return frames.aligned_strides(cams, "user_id", "event_type", "ts", "fps", 3, 5, verify=False)


STRIDES_SQL = """WITH h AS (SELECT DISTINCT user_id, event_type, epoch_ms(ts) // 3600000 AS t FROM events WHERE event_type IN ('click', 'view')),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY t) - 1 AS i FROM h), c AS (SELECT user_id, event_type, count(*) AS n, min(t) AS lo, max(t) AS hi FROM h GROUP BY 1, 2),
s AS (SELECT user_id, min(lo) AS a, min(hi) AS z FROM c GROUP BY user_id), p AS (SELECT user_id, k AS idx, a + k * 120 AS p FROM s, generate_series(0, 5000) AS g(k) WHERE a + k * 120 < z),
f AS (SELECT p.user_id, idx, r.event_type, p, arg_min(i, (abs(t - p), i)) AS first FROM p JOIN r ON r.user_id = p.user_id GROUP BY ALL),
o AS (SELECT f.*, f.first + 3 AS last, p < hi AND f.first + 3 < n AS ok FROM f JOIN c ON c.user_id = f.user_id AND c.event_type = f.event_type),
e AS (SELECT user_id, min(idx) FILTER (NOT ok) AS stop FROM o GROUP BY user_id)
SELECT o.user_id, idx, event_type, "first", "last" FROM o JOIN e ON e.user_id = o.user_id WHERE stop IS NULL OR idx < stop"""


def instance_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Line items as detections of parts in orders: first and last time at 2 frames a second, and frames."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    return frames.instances(rows, "l_orderkey", "l_suppkey", "l_linenumber", 2.0)


INSTANCE_SQL = "SELECT l_orderkey, l_suppkey, min(l_linenumber) / 2.0::DOUBLE AS start_time_s, max(l_linenumber) / 2.0::DOUBLE AS end_time_s, count(*) AS num_frames FROM lineitem GROUP BY 1, 2"


def event_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Neighbouring event numbers of each user."""
    return frames.pairwise(table(spark, d, "events").select("user_id", "event_id"), "user_id", "event_id", "event_id")


PAIRS_SQL = "SELECT user_id, event_id, nx AS next FROM (SELECT user_id, event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS nx FROM events) t WHERE nx IS NOT NULL"


def common_spans(spark: SparkSession, d: str) -> DataFrame:
    """The time that all suppliers of a nation have in common, from 0."""
    cams = table(spark, d, "supplier").select("s_nationkey", (F.col("s_suppkey") % 5).cast("double").alias("start"), (F.floor(F.abs("s_acctbal")) + 20).cast("double").alias("seconds"))
    return frames.common_span(cams, "s_nationkey", "start", "seconds")


COMMON_SQL = """SELECT s_nationkey, 0.0::DOUBLE AS "start", min(s_suppkey % 5 + floor(abs(s_acctbal)) + 20)::DOUBLE - max(s_suppkey % 5)::DOUBLE AS "end" FROM supplier GROUP BY s_nationkey"""


def condition_tags(spark: SparkSession, d: str) -> DataFrame:
    """Conditions named in a caption built for each part; each fifth caption lacks one."""
    parts = table(spark, d, "part").withColumn("c", F.expr("'**Visibility Condition:** ' || p_brand || '.\\n**Road Surface Condition:** ' || p_type || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '\\nIllumination Condition: Size ' || p_size || '..' END"))
    tags = text.condition_tags(F.col("c"))
    return parts.select("p_partkey", tags.visibility.alias("visibility"), tags.road_condition.alias("road"), tags.illumination.alias("light"))


TAGS_SQL = "SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN lower(p_brand) END AS visibility, CASE WHEN p_partkey % 5 <> 0 THEN lower(p_type) END AS road, CASE WHEN p_partkey % 5 <> 0 THEN 'size ' || p_size END AS light FROM part"


def event_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Events of a fenced model answer made of two events' properties; each ninth is broken."""
    rows = table(spark, d, "events").withColumn("a", F.expr("'```json\\n{\"n\": 1, \"events\": [' || props || ', ' || props || CASE WHEN event_id % 9 = 0 THEN '' ELSE ']}' END || '\\n```'"))
    return rows.select("event_id", F.size(text.events_payload(F.col("a"))).cast("long").alias("n_events"))


PAYLOAD_SQL = "SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 0 ELSE 2 END::BIGINT AS n_events FROM events"


def motion_cells(spark: SparkSession, d: str) -> DataFrame:
    """Mean and least event value of each user as motion of cells, and whether it is small."""
    cells = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.floor(F.abs("value") * 100).cast("double"))).alias("v"))
    m = frames.small_motion(F.col("v"), 2000.0, 5.0)
    return cells.select("user_id", F.round(m.mean, 4).alias("mean"), m.patch.alias("patch"), m.small.alias("small"))


MOTION_SQL = """WITH c AS (SELECT user_id, floor(abs(value) * 100)::DOUBLE AS v FROM events WHERE value IS NOT NULL) SELECT user_id, round(avg(v), 4) AS mean, min(v) AS patch, avg(v) < 2000.0 OR min(v) < 5.0 AS small FROM c GROUP BY user_id"""


def task_weights(spark: SparkSession, d: str) -> DataFrame:
    """Weight of each document's task when clips of its odd seconds are missing, and its lower-cased source."""
    docs = table(spark, d, "documents").withColumn("n", F.floor(F.col("n_chars") / 100))
    return docs.select("doc_id", F.lower("source").alias("source"), F.round(frames.weight(F.col("n_chars") / 100.0, F.ceil(F.col("n") / 2), F.col("n")), 6).alias("weight"))


WEIGHT_SQL = "SELECT doc_id, lower(source) AS source, round(n_chars / 100.0::DOUBLE / 300 * coalesce(ceil((n_chars // 100) / 2.0::DOUBLE) / nullif(n_chars // 100, 0), 1.0), 6) AS weight FROM documents"


def caption_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Turns of each conversation in chunks of three, as lists."""
    made = frames.chunked_by_count(table(spark, d, "conversations"), "conv_id", ["turn", "text"], 3)
    return made.groupBy("conv_id", "chunk_index").agg(joined(F.array_sort(F.collect_list("turn"))).alias("turns"))


COUNT_SQL = """SELECT conv_id, chunk_index, string_agg(turn::VARCHAR, ',' ORDER BY turn) AS turns FROM (SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1) // 3 AS chunk_index FROM conversations) t GROUP BY ALL"""

QUERIES = {f.__name__: f for f in (clip_chunks, frame_sampling, frame_regularity, camera_strides, instance_rollup, event_pairs, common_spans, condition_tags, event_payloads, motion_cells, task_weights, caption_chunks)}
ORACLES = {
    "clip_chunks": CHUNKS_SQL,
    "frame_sampling": SAMPLING_SQL,
    "frame_regularity": REGULAR_SQL,
    "camera_strides": STRIDES_SQL,
    "instance_rollup": INSTANCE_SQL,
    "event_pairs": PAIRS_SQL,
    "common_spans": COMMON_SQL,
    "condition_tags": TAGS_SQL,
    "event_payloads": PAYLOAD_SQL,
    "motion_cells": MOTION_SQL,
    "task_weights": WEIGHT_SQL,
    "caption_chunks": COUNT_SQL,
}
