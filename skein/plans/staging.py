"""Queries of the model-backed stages, with deterministic kernels, and their SQL."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import text
from skein.operators import kernels, shots, spans, stages
from skein.plans.cutting import CAPTION_WINDOWS_SQL
from skein.plans.framing import SAMPLING_SQL
from skein.plans.tables import joined, micros, table


def _documents(spark: SparkSession, d: str, *more: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.encode("text", "utf-8").alias("content"), *more)


def shot_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows of a shot detector over each document's characters as frames."""
    return table(spark, d, "documents").select("doc_id", F.inline(shots.batch_ranges(F.col("n_chars"))))


SHOT_WINDOWS_SQL = """SELECT doc_id, i AS idx, greatest(i * 50 - 25, 0) AS start, least(i * 50 + 75, n_chars) AS "end", greatest(25 - i * 50, 0) AS front
FROM documents, generate_series(0, 100000) AS g(i) WHERE i * 50 < n_chars"""


def _window_probabilities(frames, windows):
    filled = ([frames[0]] * w["front"] + frames[w["start"] : w["end"]] for w in windows)
    return ([[0.9 if x else 0.1 for x in part] for part in filled],)


def _flags(content):
    return ([b - 48 for b in content],)


def shot_stage(spark: SparkSession, d: str) -> DataFrame:
    """Transitions that a detector finds in each user's events, errors being transitions: decoded to frames, through the
    detector's windows and back."""
    ev = table(spark, d, "events").select("user_id", F.struct("ts", "event_id", (F.col("event_type") == "error").cast("int").alias("e")).alias("x"))
    rows = ev.groupBy("user_id").agg(F.encode(joined(F.array_sort(F.collect_list("x"))["e"], ""), "utf-8").alias("content"))
    rows = stages.DECODE_SMALL(rows, kernels.Rowwise(stages.DECODE_SMALL.answer, _flags, "content"))
    made = stages.DETECT_SHOTS(rows, kernels.Rowwise(stages.DETECT_SHOTS.answer, _window_probabilities, "frames", "windows"), threshold=0.5)
    return made.select("user_id", joined(F.col("transitions"), "").alias("transitions"))


SHOT_STAGE_SQL = "SELECT user_id, string_agg(CASE WHEN event_type = 'error' THEN '1' ELSE '0' END, '' ORDER BY ts, event_id) AS transitions FROM events GROUP BY user_id"


def _scores(content):
    return ([b / 255 for b in hashlib.sha256(content).digest()[:4]],)


def aesthetic_stage(spark: SparkSession, d: str) -> DataFrame:
    """The least of four frame scores of each document, and which miss a threshold."""
    made = stages.AESTHETIC(_documents(spark, d), kernels.Rowwise(stages.AESTHETIC.answer, _scores, "content"), reduction="min")
    return stages.rejected_by_score(made, 0.2).select("doc_id", F.round("aesthetic_score", 6).alias("score"), "stage_rejected")


AESTHETIC_SQL = """SELECT doc_id, round(s, 6) AS score, CASE WHEN s < 0.2 THEN 'aesthetic' END AS stage_rejected
FROM (SELECT doc_id, list_min(list_transform(range(4), lambda i: ('0x' || sha256(text)[2 * i + 1 : 2 * i + 2])::INT)) / 255.0::DOUBLE AS s FROM documents) t"""


def _answer(prompt, start, end):
    if end % 6 == 5:
        raise ValueError("no frames")
    reason = {0: "content_filter", 1: "length"}.get(end % 5, "stop")
    return (" " if end % 5 == 2 else f"{prompt} from {start}", reason, 3, end - start)


def caption_stage(spark: SparkSession, d: str) -> DataFrame:
    """Captions of each document's windows: status, text and tokens; a kernel that fails leaves its window with an error."""
    docs = table(spark, d, "documents").select("doc_id", F.col("n_chars").alias("num_frames"))
    kernel = kernels.Rowwise(stages.CAPTION.answer, _answer, "prompt", "start_frame", "end_frame")
    made = stages.CAPTION(docs, kernel, prompt="scene", batch_rows=1)
    return made.select("doc_id", F.col("window_idx").cast("long").alias("window_idx"), "status", F.col("captions")["default"].alias("caption"), "output_tokens", F.col("errors")["caption"].alias("error"))


CAPTION_SQL = f"""WITH c AS ({CAPTION_WINDOWS_SQL}), k AS (SELECT *, end_frame % 6 = 5 AS fails, CASE end_frame % 5 WHEN 0 THEN 'content_filter' WHEN 1 THEN 'length' ELSE 'stop' END AS reason, end_frame % 5 = 2 AS blank FROM c),
s AS (SELECT *, CASE WHEN fails THEN 'error' WHEN reason = 'content_filter' THEN 'blocked' WHEN blank THEN 'error' WHEN reason = 'length' THEN 'truncated' ELSE 'success' END AS status FROM k)
SELECT doc_id, window_idx, status, CASE WHEN status IN ('success', 'truncated') THEN 'scene from ' || start_frame END AS caption, CASE WHEN NOT fails THEN end_frame - start_frame END AS output_tokens,
  CASE WHEN fails THEN 'ValueError: no frames' END AS error FROM s"""


def _encoded(caption):
    return ([float(b) for b in hashlib.sha256(caption.encode()).digest()[:2]],)


def text_encoder_stage(spark: SparkSession, d: str) -> DataFrame:
    """Turns as windows with captions of two kinds or none: each distinct one encoded once, in window order by conversation."""
    captions = F.expr("CASE WHEN turn % 2 = 0 THEN map('long', text, 'short', role) WHEN turn % 3 = 0 THEN map('short', role) ELSE map() END")
    windows = table(spark, d, "conversations").select("conv_id", F.col("turn").alias("window_idx"), captions.cast("map<string,string>").alias("captions"))
    made = stages.encoded_captions(windows, "conv_id", kernels.Rowwise(stages.ENCODE_TEXT.answer, _encoded, "caption"), ["long", "short"])
    return made.select("conv_id", "valid", joined(F.transform(F.flatten("embeddings"), lambda x: x.cast("int"))).alias("embeddings"))


ENCODER_SQL = """WITH w AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN text WHEN turn % 3 = 0 THEN role END AS c FROM conversations),
e AS (SELECT *, ('0x' || sha256(c)[1:2])::INT || ',' || ('0x' || sha256(c)[3:4])::INT AS x FROM w)
SELECT conv_id, bool_and(c IS NOT NULL) AS valid, coalesce(string_agg(x, ',' ORDER BY turn, ('0x' || sha256(c)[1:2])::INT, ('0x' || sha256(c)[3:4])::INT) FILTER (c IS NOT NULL), '') AS embeddings FROM e GROUP BY conv_id"""


def _detections(content):
    return ([{"frame": f, "object_id": f % 3} for f in range(len(content) % 20)],)


def tracking_stage(spark: SparkSession, d: str) -> DataFrame:
    """Objects that a tracker finds in each document, with their time and frames at 8 a second."""
    rows = _documents(spark, d).withColumnRenamed("doc_id", "clip_uuid")
    return stages.TRACK_OBJECTS(rows, kernels.Rowwise(stages.TRACK_OBJECTS.answer, _detections, "content"), rate=8.0)


TRACKING_SQL = """SELECT doc_id AS clip_uuid, f % 3 AS object_id, min(f) / 8.0::DOUBLE AS start_time_s, max(f) / 8.0::DOUBLE AS end_time_s, count(*) AS num_frames
FROM documents, generate_series(0, 19) AS g(f) WHERE f < strlen(text) % 20 GROUP BY 1, 2"""


def _events_of(prompt):
    return ('```json\n{"events": [{"n": ' + str(len(prompt)) + '}, {"n": 0}]}\n```' if len(prompt) % 2 else "nothing to see",)


def event_stage(spark: SparkSession, d: str) -> DataFrame:
    """Events that a captioner writes about each document's instances; answers that are no JSON have none."""
    docs = table(spark, d, "documents").select("doc_id", F.array(F.struct(F.col("doc_id").alias("id"))).alias("instances"), (F.col("n_chars") / 10.0).alias("seconds"))
    made = stages.EVENT_CAPTIONS(docs, kernels.Rowwise("answer string", _events_of, "prompt"), template="Objects {instances} in {duration} s")
    return made.select("doc_id", F.array_join("events", ";").alias("events"))


EVENT_SQL = """SELECT doc_id, CASE WHEN n % 2 = 1 THEN '{"n":' || n || '};{"n":0}' ELSE '' END AS events
FROM (SELECT doc_id, length('Objects [{"id":' || doc_id || '}] in ' || (n_chars // 10) || '.' || (n_chars % 10) || ' s') AS n FROM documents) t"""


def _remuxed(data):
    if data is not None and len(data) % 5 == 0:
        raise ValueError("cut file")
    return (None if data is None else data + b"!",)


def remux_stage(spark: SparkSession, d: str) -> DataFrame:
    """Documents in three containers, those of one left as they are, and what could not be remuxed."""
    rows = _documents(spark, d).withColumn("container", F.element_at(F.array(F.lit("mp4"), F.lit("ts"), F.lit("mkv")), (F.col("doc_id") % 3 + 1).cast("int")))
    made = stages.REMUX(rows, kernels.Rowwise(stages.BYTES, _remuxed, "input"), batch_rows=1)
    return made.select("doc_id", "was_remuxed", F.md5("content").alias("digest"), F.col("errors")["remux"].alias("error"))


REMUX_SQL = """SELECT doc_id, ts AND NOT cut AS was_remuxed, md5(CASE WHEN ts AND NOT cut THEN text || '!' ELSE text END) AS digest, CASE WHEN ts AND cut THEN 'ValueError: cut file' END AS error
FROM (SELECT doc_id, text, doc_id % 3 > 0 AS ts, strlen(text) % 5 = 0 AS cut FROM documents) t"""


def _numbers(content):
    return (list(range(len(content) % 40)),)


def frame_rates_stage(spark: SparkSession, d: str) -> DataFrame:
    """Frames of each document at 2 and 3 a second, from one decoding at their common rate."""
    made = stages.CLIP_FRAMES(_documents(spark, d), kernels.Rowwise(stages.CLIP_FRAMES.answer, _numbers, "content"), rates=(2, 3))
    return made.select("doc_id", F.explode("frames_by_rate").alias("signature", "f")).select("doc_id", "signature", joined(F.col("f")).alias("frames"))


RATES_SQL = """SELECT doc_id, s AS signature, array_to_string(list_filter(range(strlen(text) % 40), lambda x: x % k = 0), ',') AS frames FROM documents, (VALUES ('2fps', 3), ('3fps', 2)) v(s, k)"""


def _ends(start, end):
    return ([start, end],)


def window_split_stage(spark: SparkSession, d: str) -> DataFrame:
    """Each document's windows with what a decoder gives for them: here their first and last frame."""
    docs = table(spark, d, "documents").select("doc_id", F.col("n_chars").alias("num_frames"))
    made = stages.SPLIT_WINDOWS(docs, kernels.Rowwise(stages.SPLIT_WINDOWS.answer, _ends, "start_frame", "end_frame"), window=256, remainder=128)
    return made.select("doc_id", F.col("window_idx").cast("long").alias("window_idx"), joined(F.col("frames")).alias("frames"))


SPLIT_WINDOWS_SQL = f"SELECT doc_id, window_idx, start_frame || ',' || end_frame AS frames FROM ({CAPTION_WINDOWS_SQL}) t"


def _decoded(plan):
    return ([p["idx"] for p in plan or [] for _ in range(p["n"])],)


def exact_decode_stage(spark: SparkSession, d: str) -> DataFrame:
    """Frames decoded by a plan: those of a user's hours nearest to a grid, each as often as it is wanted."""
    hours = table(spark, d, "events").select("user_id", (F.floor(micros("ts") / 3_600_000_000) * 3600.0).alias("t")).distinct()
    rows = hours.groupBy("user_id").agg(F.array_sort(F.collect_list("t")).alias("times"))
    made = stages.DECODE_EXACT(rows, kernels.Rowwise(stages.DECODE_EXACT.answer, _decoded, "plan"), rate=1 / 172_800.0)
    return made.select("user_id", F.size("frames").cast("long").alias("n"), F.aggregate("frames", F.lit(0).cast("long"), lambda a, x: a + x).alias("checksum"))


DECODE_SQL = f"SELECT user_id, sum(n)::BIGINT AS n, sum(idx * n)::BIGINT AS checksum FROM ({SAMPLING_SQL}) t GROUP BY user_id"


def _corner(content):
    content = content or b""
    at = len(content) % 4 * 0.25
    return ([{"frame": f, "x0": at, "y0": at, "x1": at + 0.25, "y1": at + 0.25} for f in range(len(content) % 3)],)


def overlay_text_stage(spark: SparkSession, d: str) -> DataFrame:
    """Tracks of overlay text in each document and how often it is in a corner."""
    rows = _documents(spark, d).withColumnRenamed("doc_id", "clip_uuid")
    made = stages.OVERLAY_TEXT(rows, kernels.Rowwise(stages.OVERLAY_TEXT.answer, _corner, "content"), interval=1)
    return made.select("clip_uuid", "n_tracks", "share")


OVERLAY_SQL = """SELECT doc_id AS clip_uuid, CASE WHEN strlen(text) % 3 > 0 THEN 1 ELSE 0 END::BIGINT AS n_tracks, CASE WHEN strlen(text) % 3 > 0 AND strlen(text) % 4 IN (0, 3) THEN 1.0 ELSE 0.0 END::DOUBLE AS share FROM documents"""


def _appended(mark):
    def run(content):
        return (content + mark,)

    return run


def byte_stages(spark: SparkSession, d: str) -> DataFrame:
    """Transcoding, super resolution and preview of every document one after the other, by digest of what comes out."""
    rows = _documents(spark, d).withColumn("span", F.array(F.lit(0.0), F.lit(1.0)))
    for stage, mark in ((stages.TRANSCODE, b"t"), (stages.SUPER_RESOLUTION, b"s"), (stages.PREVIEW, b"p")):
        rows = stage(rows, kernels.Rowwise(stages.BYTES, _appended(mark), "content")).drop("content").withColumnRenamed("output", "content")
    return rows.select("doc_id", F.md5("content").alias("digest"), F.size("errors").cast("long").alias("n_errors"))


def _first_bytes(content):
    return ([float(b) for b in hashlib.sha256(content).digest()[:3]],)


def embedding_stages(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings of every document as a clip and, under a model's name, as an image."""
    kernel = kernels.Rowwise("embedding array<float>", _first_bytes, "content")
    rows = stages.EMBED_IMAGE(_documents(spark, d), kernel, model="small").withColumnRenamed("embeddings", "images")
    made = stages.EMBED_CLIP(rows, kernel)
    shown = lambda v: joined(F.transform(v, lambda x: x.cast("int")))
    return made.select("doc_id", shown(F.col("embedding")).alias("clip"), shown(F.col("images")["small"]).alias("image"))


EMBEDDINGS_SQL = """SELECT doc_id, x AS clip, x AS image FROM (SELECT doc_id, array_to_string(list_transform(range(3), lambda i: ('0x' || sha256(text)[2 * i + 1 : 2 * i + 2])::INT), ',') AS x FROM documents) t"""


def _said(prompt, variant, start):
    return f"{variant}: {prompt} {start}", "stop", 1, 1


def camera_caption_stage(spark: SparkSession, d: str) -> DataFrame:
    """Captions of two variants of each document's windows, each under its variant."""
    docs = table(spark, d, "documents").select("doc_id", F.col("n_chars").alias("num_frames"))
    made = stages.CAPTION_CAMERA(docs, kernels.Rowwise(stages.ANSWER, _said, "prompt", "variant", "start_frame"), prompt="road", variants=("default", "visibility"))
    return made.select("doc_id", F.col("window_idx").cast("long").alias("window_idx"), F.explode("captions").alias("variant", "caption"))


CAMERA_SQL = f"SELECT doc_id, window_idx, v AS variant, v || ': road ' || start_frame AS caption FROM ({CAPTION_WINDOWS_SQL}) t, (VALUES ('default'), ('visibility')) x(v)"


def _pictured(content, prompt):
    return f"{prompt} {len(content)}", "length" if len(content) % 2 else "stop", 1, 1


def _finer(caption):
    return (None if caption is None else caption.upper(),)


def text_stages(spark: SparkSession, d: str) -> DataFrame:
    """Captions of documents as images, enhanced by a chat model, and text generated from those."""
    rows = stages.CAPTION_IMAGE(_documents(spark, d), kernels.Rowwise(stages.ANSWER, _pictured, "content", "prompt"), prompt="photo of")
    rows = rows.drop("prompt").withColumn("caption", F.col("captions")["default"])
    rows = stages.ENHANCE(rows, kernels.Rowwise("enhanced string", _finer, "caption")).withColumnRenamed("enhanced", "prompt")
    made = stages.GENERATE_TEXT(rows, kernels.Rowwise("generated string", _finer, "prompt"))
    return made.select("doc_id", "status", "caption", "generated")


TEXT_SQL = """SELECT doc_id, CASE WHEN strlen(text) % 2 = 1 THEN 'truncated' ELSE 'success' END AS status, 'photo of ' || strlen(text) AS caption, 'PHOTO OF ' || strlen(text) AS generated FROM documents"""


def assembled_program(spark: SparkSession, d: str) -> DataFrame:
    """A program of registered kernels built from a configuration that switches one step off."""
    registry = stages.Registry()
    registry.add("scorer", "digest", lambda: kernels.Rowwise(stages.AESTHETIC.answer, _scores, "content"))
    registry.add("embedder", "digest", lambda: kernels.Rowwise("embedding array<float>", _first_bytes, "content"))
    steps = [
        stages.Named("score", stages.using(stages.AESTHETIC, "digest", registry=registry, reduction="mean")),
        stages.Named("embed", stages.using(stages.EMBED_CLIP, "digest", registry=registry), on=False),
        stages.Named("reject", lambda df: stages.rejected_by_score(df, 0.5)),
    ]
    made = stages.assembled(steps, observed=True)(_documents(spark, d))
    return made.groupBy(F.coalesce("stage_rejected", F.lit("kept")).alias("outcome")).agg(F.count("*").alias("n_rows"))


PROGRAM_SQL = """SELECT CASE WHEN s < 0.5 THEN 'aesthetic' ELSE 'kept' END AS outcome, count(*) AS n_rows
FROM (SELECT list_sum(list_transform(range(4), lambda i: ('0x' || sha256(text)[2 * i + 1 : 2 * i + 2])::INT / 255.0::DOUBLE)) / 4 AS s FROM documents) t GROUP BY 1"""

async def _called(prompt):
    if prompt is None:
        return None
    if len(prompt) % 11 == 0:
        raise TimeoutError("no answer")
    return text.upper(prompt[:3])


def async_answers(spark: SparkSession, d: str) -> DataFrame:
    """Turns sent to an asynchronous service, a few at once; a call that fails twice is its row's own error."""
    rows = table(spark, d, "conversations").select("conv_id", "turn", "text")
    made = kernels.with_kernel(rows, kernels.AsyncCalls("text", _called, width=16, attempts=2))
    return made.select("conv_id", "turn", "answer", "answer_error", "kernel_error")


ASYNC_SQL = "SELECT conv_id, turn, CASE WHEN length(text) % 11 > 0 THEN upper(text[1:3]) END AS answer, CASE WHEN length(text) % 11 = 0 THEN 'TimeoutError: no answer' END AS answer_error, NULL::VARCHAR AS kernel_error FROM conversations"


def render_batches(spark: SparkSession, d: str) -> DataFrame:
    """Turns of each conversation in batches of three, as render work goes to a pool: their turns in order."""
    turns = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("t"))
    return turns.select("conv_id", F.posexplode(spans.batched(F.col("t"), 3)).alias("batch", "b")).select("conv_id", F.col("batch").cast("long").alias("batch"), joined(F.col("b")).alias("turns"))


BATCHES_SQL = """WITH r AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations)
SELECT conv_id, i // 3 AS batch, string_agg(turn::VARCHAR, ',' ORDER BY i) AS turns FROM r GROUP BY conv_id, i // 3"""

QUERIES = {f.__name__: f for f in (async_answers, render_batches, shot_windows, shot_stage, aesthetic_stage, caption_stage, text_encoder_stage, tracking_stage, event_stage, remux_stage, frame_rates_stage, window_split_stage, exact_decode_stage, overlay_text_stage, byte_stages, embedding_stages, camera_caption_stage, text_stages, assembled_program)}
ORACLES = {
    "async_answers": ASYNC_SQL,
    "render_batches": BATCHES_SQL,
    "shot_windows": SHOT_WINDOWS_SQL,
    "shot_stage": SHOT_STAGE_SQL,
    "aesthetic_stage": AESTHETIC_SQL,
    "caption_stage": CAPTION_SQL,
    "text_encoder_stage": ENCODER_SQL,
    "tracking_stage": TRACKING_SQL,
    "event_stage": EVENT_SQL,
    "remux_stage": REMUX_SQL,
    "frame_rates_stage": RATES_SQL,
    "window_split_stage": SPLIT_WINDOWS_SQL,
    "exact_decode_stage": DECODE_SQL,
    "overlay_text_stage": OVERLAY_SQL,
    "byte_stages": "SELECT doc_id, md5(text || 'tsp') AS digest, 0::BIGINT AS n_errors FROM documents",
    "embedding_stages": EMBEDDINGS_SQL,
    "camera_caption_stage": CAMERA_SQL,
    "text_stages": TEXT_SQL,
    "assembled_program": PROGRAM_SQL,
}
