"""Queries on cutting, filtering and describing recordings, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import geometry, ids, text
from skein.operators import routing, spans, summary, tracks
from skein.plans.tables import micros, table

def duration():
    """Seconds of a document: one for each 100 characters."""
    return F.col("n_chars") / 100.0


def fixed_stride_clips(spark: SparkSession, d: str) -> DataFrame:
    """Documents as recordings (a second for each 100 characters) cut into clips of 10 s; ids by name."""
    docs = table(spark, d, "documents")
    cut = spans.fixed_stride(F.lit(0.0), duration(), 10.0, 10.0, 2.0)
    clips = docs.select("doc_id", "source", F.posexplode(cut).alias("clip_idx", "s"))
    start, end = F.col("s.start"), F.col("s.end")
    return clips.select("doc_id", F.col("clip_idx").cast("long").alias("clip_idx"), start.alias("start_s"), end.alias("end_s"), ids.clip_uuid(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")), start, end).alias("clip_uuid"))


def _uuid_sql(name: str) -> str:
    h = f"sha1(unhex('{ids.NAMESPACE_URL}') || encode({name}))"
    nibble = f"printf('%x', (instr('0123456789abcdef', {h}[17]) - 1) % 4 + 8)"
    return f"({h}[1:8] || '-' || {h}[9:12] || '-5' || {h}[14:16] || '-' || {nibble} || {h}[18:20] || '-' || {h}[21:32])"


CLIPS_SQL = """
SELECT doc_id, source, i AS clip_idx, i * 10.0::DOUBLE AS start_s, least(i * 10.0::DOUBLE + 10.0, n_chars / 100.0::DOUBLE) AS end_s
FROM documents, generate_series(0, 100000) AS g(i)
WHERE i * 10.0 < n_chars / 100.0::DOUBLE AND least(i * 10.0::DOUBLE + 10.0, n_chars / 100.0::DOUBLE) - i * 10.0::DOUBLE >= 2.0"""
FIXED_STRIDE_SQL = f"SELECT doc_id, clip_idx, start_s, end_s, {_uuid_sql('$n')} AS clip_uuid FROM ({CLIPS_SQL}) t".replace("$n", "('doc-' || doc_id || '_' || start_s::VARCHAR || '_' || end_s::VARCHAR)")


def limited_clips(spark: SparkSession, d: str) -> DataFrame:
    """The first 50 clips of each recording at most, a limit that a run may set: how many, and where the last ends."""
    cut = spans.fixed_stride(F.lit(0.0), duration(), 10.0, 10.0, 2.0, 50)
    return table(spark, d, "documents").select("doc_id", cut.alias("s")).filter(F.size("s") > 0).select("doc_id", F.size("s").cast("long").alias("n_clips"), F.element_at("s", -1)["end"].alias("last_s"))


LIMITED_SQL = f"SELECT doc_id, count(*) AS n_clips, max(end_s) AS last_s FROM ({CLIPS_SQL}) t WHERE clip_idx < 50 GROUP BY doc_id"


def overlapping_clips(spark: SparkSession, d: str) -> DataFrame:
    """Clips of 8 s every 4 s, at least 3 s long: how many a recording has and how many seconds they come to."""
    docs = table(spark, d, "documents")
    made = docs.select("doc_id", spans.fixed_stride(F.lit(0.0), duration(), 8.0, 4.0, 3.0).alias("s"))
    return made.select("doc_id", F.size("s").cast("long").alias("n_clips"), F.round(F.aggregate("s", F.lit(0.0), lambda a, x: a + x["end"] - x["start"]), 4).alias("total_s"))


OVERLAPPING_SQL = """
SELECT doc_id, count(i) AS n_clips, round(coalesce(sum(least(i * 4.0 + 8.0, dur) - i * 4.0), 0.0), 4)::DOUBLE AS total_s
FROM (SELECT doc_id, n_chars / 100.0::DOUBLE AS dur FROM documents) t
LEFT JOIN generate_series(0, 100000) AS g(i) ON i * 4.0 < dur AND least(i * 4.0::DOUBLE + 8.0, dur) - i * 4.0::DOUBLE >= 3.0
GROUP BY doc_id"""


def clip_summary(spark: SparkSession, d: str) -> DataFrame:
    """Clips, seconds and longest clip of each source."""
    docs = table(spark, d, "documents")
    clips = docs.select("source", F.inline(spans.fixed_stride(F.lit(0.0), duration(), 10.0, 10.0, 2.0)))
    return summary.clip_stats(clips, "source", "start", "end")


CLIP_SUMMARY_SQL = f"""
SELECT source, count(*) AS n_clips, round(sum(end_s - start_s), 4) AS total_s, round(max(end_s - start_s), 4) AS max_s
FROM ({CLIPS_SQL}) t GROUP BY source"""


def split_summary(spark: SparkSession, d: str) -> DataFrame:
    """All customers as inputs, their orders as chunks: sums, greatest value, and who was not processed."""
    inputs = table(spark, d, "customer").select(F.col("c_custkey").alias("input"))
    chunks = table(spark, d, "orders").select(F.col("o_custkey").alias("input"), F.round(F.col("o_totalprice") * 100).cast("long").alias("n_bytes"), F.lit(1).cast("long").alias("n_chunks"), F.length("o_orderpriority").cast("long").alias("longest"))
    return summary.split_summary(inputs, chunks, "input", ["n_bytes", "n_chunks"], ["longest"])


SPLIT_SUMMARY_SQL = """
SELECT c_custkey AS input, coalesce(sum(round(o_totalprice * 100)::BIGINT), 0)::BIGINT AS n_bytes, count(o_orderkey) AS n_chunks,
  coalesce(max(length(o_orderpriority)), 0)::BIGINT AS longest, count(o_orderkey) > 0 AS processed
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey"""


def caption_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows of 256 frames (a character is a frame), remainders from 128 on apart, with the time of their ends."""
    docs = table(spark, d, "documents")
    w = docs.select("doc_id", "n_chars", F.posexplode(spans.caption_windows(F.col("n_chars"), 256, 128)).alias("window_idx", "w"))
    at = spans.frame_time(F.col("w.end"), F.col("n_chars"), duration())
    return w.select("doc_id", F.col("window_idx").cast("long").alias("window_idx"), F.col("w.start").alias("start_frame"), F.col("w.end").alias("end_frame"), F.round(at, 4).alias("end_s"))


CAPTION_WINDOWS_SQL = """
WITH t AS (SELECT doc_id, n_chars AS n, n_chars // 256 AS f, n_chars % 256 AS r FROM documents WHERE n_chars >= 4),
w AS (SELECT doc_id, n, i, i * 256 AS s, CASE WHEN i = f - 1 AND r < 128 THEN n - 1 ELSE least(i * 256 + 255, n - 1) END AS e
  FROM t, generate_series(0, 100000) AS g(i) WHERE CASE WHEN n <= 256 THEN i = 0 ELSE i < f + CASE WHEN r >= 128 THEN 1 ELSE 0 END END)
SELECT doc_id, i AS window_idx, s AS start_frame, e AS end_frame, round(e / greatest(n - 1, 1)::DOUBLE * (n / 100.0::DOUBLE), 4) AS end_s FROM w"""


def scene_islands(spark: SparkSession, d: str) -> DataFrame:
    """Shots of each user's events, where an error is a transition; split every 40 events, from 2 events on."""
    ev = table(spark, d, "events").select("user_id", "ts", "event_id", (F.col("event_type") == "error").cast("int").alias("flag"))
    shots = spans.scenes(ev, "user_id", ["ts", "event_id"], "flag")
    return spans.filtered_scenes(shots, min_length=2, max_length=40, mode="truncate", crop=0)


SCENES_SQL = """
WITH n AS (SELECT user_id, row_number() OVER w - 1 AS i, (event_type = 'error')::INT AS t,
    coalesce(lag((event_type = 'error')::INT) OVER w, 0) AS b, count(*) OVER (PARTITION BY user_id) AS n
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
o AS (SELECT *, coalesce(max(CASE WHEN b = 1 AND t = 0 THEN i END) OVER (PARTITION BY user_id ORDER BY i), 0) AS s,
    (b = 0 AND t = 1 AND i > 0) AS c FROM n),
f AS (SELECT *, sum(c::INT) OVER (PARTITION BY user_id) AS found FROM o),
sh AS (SELECT user_id, s AS a, least(s + 40, i) AS z FROM f WHERE c OR (i = n - 1 AND t = 0 AND found > 0))
SELECT user_id, a::BIGINT AS "start", z::BIGINT AS "end" FROM sh WHERE z > a AND z - a >= 2"""


def route_filters(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents through three filters; each outcome's rows, bytes and largest row by source."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    rows = routing.reject(docs, routing.aesthetic(F.when(F.col("quality").isNotNull(), F.array(F.col("quality").cast("double"), F.lit(0.7))), 0.5), "aesthetic")
    rows = routing.reject(rows, routing.motion(F.col("n_chars").cast("double"), F.length("source").cast("double"), 500.0, 4.5), "motion")
    rows = routing.reject(rows, F.col("toxic") == 1, "semantic")
    outcome = F.coalesce(routing.REJECTED, F.lit("kept"))
    return rows.groupBy("source", outcome.alias("outcome")).agg(F.count("*").alias("n_rows"), F.sum("n_chars").alias("n_bytes"), F.max("n_chars").alias("max_bytes"))


ROUTE_SQL = """
SELECT source, outcome, count(*) AS n_rows, sum(n_chars)::BIGINT AS n_bytes, max(n_chars) AS max_bytes FROM (
  SELECT source, n_chars, CASE WHEN quality IS NULL OR least(quality, 0.7) < 0.5 THEN 'aesthetic'
    WHEN n_chars < 500 OR length(source) < 4.5 THEN 'motion' WHEN toxic = 1 THEN 'semantic' ELSE 'kept' END AS outcome
  FROM documents LEFT JOIN labels USING (doc_id)) t GROUP BY source, outcome"""

ANSWER = """'<think>hm {no}</think> Sure: {"synthetic image": "' || CASE WHEN length(text) % 3 = 0 THEN 'yes' ELSE 'no' END || '", "blur": "' || CASE WHEN role = 'user' THEN 'yes' ELSE 'no' END || '", "space": "' || CASE WHEN length(text) % 5 = 0 THEN 'yes' ELSE 'no' END || '"' || CASE WHEN length(text) % 7 = 0 THEN '' ELSE '}' END"""


def _answers(spark: SparkSession, d: str) -> DataFrame:
    """Turns as windows with a model answer made of their lengths; each seventh one is cut off."""
    return table(spark, d, "conversations").withColumn("answer", F.expr(ANSWER))


def semantic_filter(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as clips: share of windows with a "yes" on a criterion against a threshold."""
    windows = _answers(spark, d).filter("turn > 0")
    clips = table(spark, d, "conversations").select("conv_id").distinct()
    out = routing.semantic_verdicts(clips, windows, "conv_id", "answer", ["synthetic image", "blur"], 0.6)
    return out.select("conv_id", "n_windows", "n_malformed", "n_rejected", "passes", "error", F.coalesce(F.array_join("issues", ","), F.lit("")).alias("issues"))


WINDOWS_SQL = """w AS (SELECT conv_id, turn, length(text) % 7 = 0 AS bad, length(text) % 3 = 0 AS a, role = 'user' AS b, length(text) % 5 = 0 AS s FROM conversations)"""
SEMANTIC_SQL = f"""
WITH {WINDOWS_SQL}, g AS (SELECT conv_id, count(*) AS n, count(*) FILTER (bad) AS m, count(*) FILTER (NOT bad AND (a OR b)) AS r,
  bool_or(a AND NOT bad) AS ia, bool_or(b AND NOT bad) AS ib FROM w WHERE turn > 0 GROUP BY conv_id)
SELECT c.conv_id, coalesce(n, 0) AS n_windows, coalesce(m, 0) AS n_malformed, coalesce(r, 0) AS n_rejected,
  NOT (n IS NULL OR m = n OR r / n::DOUBLE > 0.6) AS passes,
  CASE WHEN n IS NULL THEN 'all_windows_failed_preparation' WHEN m > 0 THEN 'malformed_model_output' END AS error,
  concat_ws(',', CASE WHEN ib THEN 'blur' END, CASE WHEN ia THEN 'synthetic image' END) AS issues
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g USING (conv_id)"""


def classifier_filter(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as clips: an allowed label must be found, blocked ones not too often."""
    out = routing.classifier_verdicts(_answers(spark, d), "conv_id", "answer", ["synthetic_image"], ["space", "blur"], ["synthetic_image", "blur", "space"], 0.5, custom=True)
    return out.select("conv_id", "n_windows", "n_malformed", "n_rejected", "passes", F.array_join("issues", ",").alias("issues"), F.array_join("labels", ",").alias("labels"))


CLASSIFIER_SQL = f"""
WITH {WINDOWS_SQL} SELECT conv_id, count(*) AS n_windows, count(*) FILTER (bad) AS n_malformed, count(*) FILTER (NOT bad AND (s OR b)) AS n_rejected,
  coalesce(bool_or(a AND NOT bad), false) AND count(*) FILTER (NOT bad AND (s OR b)) / count(*)::DOUBLE <= 0.5 AS passes,
  concat_ws(',', CASE WHEN bool_or(NOT bad AND b AND NOT s) THEN 'blur' END, CASE WHEN bool_or(NOT bad AND s) THEN 'space' END) AS issues,
  CASE WHEN bool_or(NOT bad AND (a OR b OR s)) THEN concat_ws(',', CASE WHEN bool_or(NOT bad AND b) THEN 'blur' END, CASE WHEN bool_or(NOT bad AND s) THEN 'space' END, CASE WHEN bool_or(NOT bad AND a) THEN 'synthetic_image' END) ELSE 'unclassified' END AS labels
FROM w GROUP BY conv_id"""


def tolerant_json(spark: SparkSession, d: str) -> DataFrame:
    """Event properties inside a noisy model answer, parsed again; a seventh of them lacks its brace, another is no JSON."""
    ev = table(spark, d, "events").withColumn("noisy", F.expr("'<think>{</think><answer>\\n  ' || CASE WHEN event_id % 7 = 0 THEN substr(props, 1, length(props) - 1) || '</answer> and so on' WHEN event_id % 7 = 1 THEN '{\"a\": b c}</answer>' ELSE props || '</answer> and so on }' END"))
    m = text.tolerant_map(F.col("noisy"))
    return ev.select("event_id", m.isNotNull().alias("parsed"), F.array_join(F.array_sort(F.map_keys(m)), ",").alias("keys"))


TOLERANT_SQL = """
SELECT event_id, event_id % 7 > 1 AS parsed, CASE WHEN event_id % 7 > 1 THEN array_to_string(list_sort(json_keys(props::JSON)), ',') END AS keys FROM events"""


def keyword_filter(spark: SparkSession, d: str) -> DataFrame:
    """Which documents fit a keyword, after two generated phrases."""
    docs = table(spark, d, "documents").withColumn("caption", F.expr("text || CASE WHEN doc_id % 3 = 0 THEN ' the Airport' ELSE '' END || CASE WHEN doc_id % 4 = 0 THEN ' Drop-off zone' ELSE '' END"))
    fits = text.keyword_in_caption(F.col("caption"), text.KEYWORD)
    return docs.select("doc_id", fits.alias("fits"), text.keyword_in_caption(F.col("caption"), "other").alias("unknown"))


KEYWORD_SQL = """
SELECT doc_id, lower(c) LIKE '%airport%' AND (lower(c) LIKE '%pick up%' OR lower(c) LIKE '%pick-up%' OR lower(c) LIKE '%parking%' OR lower(c) LIKE '%drop off%' OR lower(c) LIKE '%drop-off%') AS fits, false AS unknown
FROM (SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN ' the Airport' ELSE '' END || CASE WHEN doc_id % 4 = 0 THEN ' Drop-off zone' ELSE '' END AS c FROM documents) t"""


def bin_assign(spark: SparkSession, d: str) -> DataFrame:
    """Clips by aspect, resolution and duration bin; those without a bin are counted as such."""
    docs = table(spark, d, "documents").withColumn("w", F.expr("320 + (doc_id * 37) % 2200")).withColumn("h", F.expr("240 + (doc_id * 53) % 1300"))
    b = geometry.video_bin(F.col("w"), F.col("h"), F.col("n_chars"), F.lit(100.0))
    return docs.groupBy(F.coalesce(b, F.lit("none")).alias("bin")).agg(F.count("*").alias("n_rows"), F.sum("n_chars").alias("n_frames"))


BIN_SQL = """
SELECT coalesce(CASE WHEN dur IS NOT NULL AND asp IS NOT NULL THEN asp || '/' || res || '/' || dur END, 'none') AS bin, count(*) AS n_rows, sum(n_chars)::BIGINT AS n_frames FROM (
  SELECT n_chars, CASE WHEN r <= 0.65 THEN '9_16' WHEN r <= 0.88 THEN '3_4' WHEN r <= 1.16 THEN '1_1' WHEN r <= 1.55 THEN '4_3' WHEN r <= 10 THEN '16_9' END AS asp,
    CASE WHEN least(w, h) >= 1080 THEN '1080' WHEN least(w, h) >= 720 THEN '720' ELSE 'lt_720' END AS res,
    CASE WHEN s BETWEEN 5 AND 10 THEN '5_10' WHEN s BETWEEN 10 AND 30 THEN '10_30' WHEN s >= 30 THEN '30_inf' END AS dur
  FROM (SELECT n_chars, n_chars / 100.0::DOUBLE AS s, w, h, w / h::DOUBLE AS r FROM (SELECT n_chars, 320 + (doc_id * 37) % 2200 AS w, 240 + (doc_id * 53) % 1300 AS h FROM documents))) t GROUP BY 1"""


def resized(spark: SparkSession, d: str) -> DataFrame:
    """Sizes after a resize by the shorter side and after one to multiples of 28, and the frames to sample."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars", F.expr("320 + (doc_id * 37) % 2200").alias("w"), F.expr("240 + (doc_id * 53) % 1300").alias("h"))
    s = geometry.smart_resize(F.col("w"), F.col("h"), 28, 200_000, 1_000_000)
    r = geometry.resized_by_shorter(F.col("w"), F.col("h"), 480)
    return docs.filter("n_chars >= 4").select("doc_id", r.width.alias("w480"), r.height.alias("h480"), s.width.alias("w28"), s.height.alias("h28"), geometry.sampled_frames(2.0, F.col("n_chars"), F.lit(30.0)).alias("n_frames"))


RESIZED_SQL = """
WITH t AS (SELECT doc_id, n_chars AS n, (320 + (doc_id * 37) % 2200)::DOUBLE AS w, (240 + (doc_id * 53) % 1300)::DOUBLE AS h FROM documents WHERE n_chars >= 4),
u AS (SELECT *, greatest(28, round_even(h / 28, 0) * 28) AS h0, greatest(28, round_even(w / 28, 0) * 28) AS w0 FROM t)
SELECT doc_id, (CASE WHEN h < w THEN 2 * floor((round_even(480 / h * w, 0) + 1) / 2) ELSE 480 END)::BIGINT AS w480,
  (CASE WHEN h < w THEN 480 ELSE 2 * floor((round_even(480 / w * h, 0) + 1) / 2) END)::BIGINT AS h480,
  (CASE WHEN h0 * w0 > 1000000 THEN floor(w / sqrt(h * w / 1000000) / 28) * 28 WHEN h0 * w0 < 200000 THEN ceil(w * sqrt(200000 / (h * w)) / 28) * 28 ELSE w0 END)::BIGINT AS w28,
  (CASE WHEN h0 * w0 > 1000000 THEN floor(h / sqrt(h * w / 1000000) / 28) * 28 WHEN h0 * w0 < 200000 THEN ceil(h * sqrt(200000 / (h * w)) / 28) * 28 ELSE h0 END)::BIGINT AS h28,
  (round_even(least(greatest(n / 30.0::DOUBLE * 2, 4.0), floor(least(768, n) / 2.0) * 2) / 2, 0) * 2)::BIGINT AS n_frames
FROM u"""


def iou_tracks(spark: SparkSession, d: str) -> DataFrame:
    """Boxes made of events, followed as tracks of each user and counted, with the share of frames with a corner box."""
    ev = table(spark, d, "events").select("user_id", F.floor(micros("ts") / 3_600_000_000).alias("frame"), (F.pmod(F.col("event_id"), F.lit(5)) * 20.0).alias("x0"), (F.pmod(F.col("event_id"), F.lit(3)) * 30.0).alias("y0"))
    boxes = ev.withColumn("x1", F.col("x0") + 20.0).withColumn("y1", F.col("y0") + 15.0).distinct()
    found = tracks.text_tracks(boxes, "user_id", 24).groupBy("user_id").agg(F.count("*").alias("n_tracks"), F.sum("n").alias("n_boxes"), F.max(F.col("last") - F.col("first")).alias("longest"))
    share = tracks.corner_share(boxes, "user_id", 100.0, 75.0).select("user_id", F.round("share", 4).alias("share"), (F.col("share") > 0.1).alias("rejected"))
    return found.join(share, "user_id")


# Boxes of the query overlap by 0.9 only if they are the same, so a track is a run of one box without a gap of over 120.
TRACKS_SQL = """WITH b AS (SELECT DISTINCT user_id, epoch_us(ts) // 3600000000 AS f, event_id % 5 AS x, event_id % 3 AS y FROM events),
g AS (SELECT *, coalesce(f - lag(f) OVER (PARTITION BY user_id, x, y ORDER BY f), 1000) > 120 AS new FROM b), r AS (SELECT *, sum(new::INT) OVER (PARTITION BY user_id, x, y ORDER BY f) AS k FROM g),
t AS (SELECT user_id, max(f) - min(f) AS long, count(*) AS n FROM r GROUP BY user_id, x, y, k), u AS (SELECT user_id, count(*) AS n_tracks, sum(n)::BIGINT AS n_boxes, max(long) AS longest FROM t GROUP BY user_id),
c AS (SELECT user_id, f, bool_or((x * 20 + 20 <= 25 OR x * 20 >= 75) AND (y * 30 + 15 <= 18.75 OR y * 30 >= 56.25)) AS corner FROM b GROUP BY user_id, f),
s AS (SELECT user_id, count(*) FILTER (corner) / count(*)::DOUBLE AS share FROM c GROUP BY user_id)
SELECT user_id, n_tracks, n_boxes, longest, round(share, 4) AS share, share > 0.1 AS rejected FROM u JOIN s USING (user_id)"""


QUERIES = {f.__name__: f for f in (clip_summary, fixed_stride_clips, limited_clips, overlapping_clips, split_summary, caption_windows, scene_islands, route_filters, semantic_filter, classifier_filter, tolerant_json, keyword_filter, bin_assign, resized, iou_tracks)}
ORACLES = {
    "clip_summary": CLIP_SUMMARY_SQL,
    "fixed_stride_clips": FIXED_STRIDE_SQL,
    "limited_clips": LIMITED_SQL,
    "overlapping_clips": OVERLAPPING_SQL,
    "split_summary": SPLIT_SUMMARY_SQL,
    "caption_windows": CAPTION_WINDOWS_SQL,
    "scene_islands": SCENES_SQL,
    "route_filters": ROUTE_SQL,
    "semantic_filter": SEMANTIC_SQL,
    "classifier_filter": CLASSIFIER_SQL,
    "tolerant_json": TOLERANT_SQL,
    "keyword_filter": KEYWORD_SQL,
    "bin_assign": BIN_SQL,
    "resized": RESIZED_SQL,
    "iou_tracks": TRACKS_SQL,
}
