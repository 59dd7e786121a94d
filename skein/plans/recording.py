"""Queries on records that leave a pipeline and the checks on what enters one, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators import records
from skein.plans.tables import joined, table


def clip_validity(spark: SparkSession, d: str) -> DataFrame:
    """Parts as clips, their line items as caption windows: valid, captioned, tokens."""
    clips = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.when(F.col("p_size") > 5, F.col("p_size")).alias("n_bytes"))
    windows = table(spark, d, "lineitem").filter("l_partkey % 3 > 0").select(F.col("l_partkey").alias("k"), F.expr("CASE l_returnflag WHEN 'R' THEN 'error' WHEN 'A' THEN 'blocked' ELSE 'success' END").alias("status"), F.col("l_linenumber").cast("long").alias("tokens"))
    return records.validity(clips, windows, "k", "n_bytes", "status", ["tokens"]).select("k", "valid", "has_caption", "total_tokens")


VALIDITY_SQL = """SELECT p_partkey AS k, p_size > 5 AND count(l_orderkey) > 0 AS valid, coalesce(bool_or(l_returnflag NOT IN ('R', 'A')), false) AS has_caption, coalesce(sum(l_linenumber), 0)::BIGINT AS total_tokens
FROM part LEFT JOIN lineitem ON l_partkey = p_partkey AND l_partkey % 3 > 0 GROUP BY p_partkey, p_size"""


def image_filter(spark: SparkSession, d: str) -> DataFrame:
    """Documents as images with one filter answer, some missing, some blocked, some broken."""
    answer = F.expr("""CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN '{broken' ELSE '{"synthetic image": "' || CASE WHEN n_chars % 2 = 0 THEN 'yes' ELSE 'no' END || '"}' END""")
    v = records.image_verdict(answer, F.expr("CASE WHEN doc_id % 14 = 0 THEN 'blocked' END"), ["synthetic image"])
    return table(spark, d, "documents").select("doc_id", v.rejected.alias("rejected"), v.stage.alias("stage"), v.error.alias("error"))


IMAGE_SQL = """SELECT doc_id, r AS rejected, CASE WHEN r THEN 'semantic' END AS stage, e AS error FROM (SELECT doc_id, doc_id % 7 = 0 OR doc_id % 5 = 0 OR n_chars % 2 = 0 AS r,
  CASE WHEN doc_id % 14 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 'all_windows_failed_preparation' WHEN doc_id % 5 = 0 THEN 'malformed_model_output' END AS e FROM documents) t"""


def decode_support(spark: SparkSession, d: str) -> DataFrame:
    """Codecs and pixel formats made of part numbers: what hardware decodes, what has ten bits, and how many parts."""
    rows = table(spark, d, "part").selectExpr("p_partkey", "element_at(array('h264', 'hevc', 'vp9', NULL), CAST(p_partkey % 4 + 1 AS INT)) AS codec", "element_at(array('yuv420p', 'yuv444p10le', 'nv16', NULL, 'yuv422p10be'), CAST(p_partkey % 5 + 1 AS INT)) AS pix")
    return rows.groupBy(records.hardware_decodes(F.col("codec"), F.col("pix")).alias("hardware"), records.ten_bit(F.col("pix")).alias("ten_bit")).agg(F.count("*").alias("n_rows"))


DECODE_SQL = """WITH t AS (SELECT ['h264', 'hevc', 'vp9', NULL][p_partkey % 4 + 1] AS c, ['yuv420p', 'yuv444p10le', 'nv16', NULL, 'yuv422p10be'][p_partkey % 5 + 1] AS x FROM part)
SELECT coalesce((c = 'h264' AND (x LIKE '%nv16%' OR x LIKE '%420p%')) OR (c = 'hevc' AND (x LIKE '%420p%' OR x LIKE '%444p%')), false) AS hardware, x LIKE '%10le%' OR x LIKE '%10be%' AS ten_bit, count(*) AS n_rows FROM t GROUP BY ALL"""


def prompt_choice(spark: SparkSession, d: str) -> DataFrame:
    """Prompts of clips of 256 frames and of front windows of 57."""
    frames = F.when(F.col("doc_id") % 2 == 0, 256).otherwise(57)
    prompts = F.create_map(F.lit("default"), F.lit("p"), F.lit("visibility"), F.lit("v"))
    return table(spark, d, "documents").select("doc_id", joined(F.array_sort(F.map_keys(records.prompts_for(frames, prompts, 256, 57)))).alias("prompts"), records.camera_number(F.format_string("cam-%02d-x.h264", F.col("doc_id") % 12), "-", 1).alias("camera"))


PROMPT_SQL = "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'default,visibility' ELSE 'default' END AS prompts, (doc_id % 12)::INT AS camera FROM documents"


def sample_grid(spark: SparkSession, d: str) -> DataFrame:
    """Points of a grid at 8 Hz over each document's time, and the last of them."""
    end = F.col("n_chars") * 10_000_000
    g = records.time_grid(F.lit(1_000_000_000).cast("long"), end + 1_000_000_000, 8.0)
    return table(spark, d, "documents").select("doc_id", F.size(g).cast("long").alias("n"), F.element_at(g, -1).alias("last"))


GRID_SQL = "SELECT doc_id, n_chars * 8 // 100 + 1 AS n, 1000000000 + (n_chars * 8 // 100) * 125000000 AS last FROM documents"


def trace_spans(spark: SparkSession, d: str) -> DataFrame:
    """Events as trace lines, each eleventh broken, parsed again."""
    line = F.expr("""CASE WHEN event_id % 11 = 0 THEN '{' ELSE '{"name": "' || event_type || '", "context": {"trace_id": "0x00ff", "span_id": "0x' || lower(hex(event_id + 1)) || '"}, "start_time": "2024-01-01T00:00:' || lpad(CAST(event_id % 60 AS STRING), 2, '0') || '.123456' || lpad(CAST(event_id % 1000 AS STRING), 3, '0') || 'Z", "end_time": null}' END""")
    return records.trace_spans(table(spark, d, "events").select(line.alias("value")))


TRACE_SQL = """SELECT event_type AS name, 'ff' AS trace_id, (event_id + 1)::VARCHAR AS span_id, (1704067200 + event_id % 60) * 1000000000 + 123456000 + event_id % 1000 AS start_ns, NULL::BIGINT AS end_ns FROM events WHERE event_id % 11 <> 0"""


def metadata_rows(spark: SparkSession, d: str) -> DataFrame:
    """Metadata of labelled and other documents as JSON without null keys, by digest, and the bytes of the row."""
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    made = records.metadata_json(rows.withColumn("n_bytes", records.nested_bytes(F.col("text"), F.col("source"))), "doc_id", ["source", "n_chars", "quality", "n_bytes"])
    return made.select("doc_id", "json")


METADATA_SQL = """SELECT doc_id, '{"source":"' || source || '","n_chars":' || n_chars || CASE WHEN quality IS NULL THEN '' ELSE ',"quality":' || quality END || ',"n_bytes":' || (strlen(text) + strlen(source)) || '}' AS json FROM documents LEFT JOIN labels USING (doc_id)"""


def sampled_checkpoint(spark: SparkSession, d: str) -> DataFrame:
    """How many orders a tenth by hash has for each priority."""
    return records.sampled(table(spark, d, "orders"), "o_orderkey", 0.1).groupBy("o_orderpriority").agg(F.count("*").alias("n_rows"))


SAMPLED_SQL = f"""SELECT o_orderpriority, count(*) AS n_rows FROM orders WHERE ('0x' || left(md5('0/' || o_orderkey), 8))::BIGINT < {int(0.1 * (1 << 32))} GROUP BY o_orderpriority"""

QUERIES = {f.__name__: f for f in (clip_validity, image_filter, decode_support, prompt_choice, sample_grid, trace_spans, metadata_rows, sampled_checkpoint)}
ORACLES = {"clip_validity": VALIDITY_SQL, "image_filter": IMAGE_SQL, "decode_support": DECODE_SQL, "prompt_choice": PROMPT_SQL, "sample_grid": GRID_SQL, "trace_spans": TRACE_SQL, "metadata_rows": METADATA_SQL, "sampled_checkpoint": SAMPLED_SQL}
