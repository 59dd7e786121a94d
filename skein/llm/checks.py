"""The columns of the operators' queries that SQL can express, as queries of their own, and that SQL; SQL for operator 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skein.llm import bpe, media, quality_rules, secret_scan


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts of operator 2 and whether they fail a document."""
    return quality_rules.op2_quality_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


BASE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
e AS (SELECT r, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
three AS (SELECT r, i, x || chr(10) || lead(x, 1) OVER o || chr(10) || lead(x, 2) OVER o AS g FROM e WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM three WHERE g IS NOT NULL) t WHERE c > 1),
again AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) v(k) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d),
dup AS (SELECT r, sum(c - 1)::BIGINT AS n FROM (SELECT r, x, count(*) AS c FROM lines WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r, x) t GROUP BY r),
f AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(again.n, 0)::BIGINT AS n_repeat_words FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN again USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f"""


def media_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sizes and digests of operator 6's payloads and files."""
    return media.op6_wav_fingerprints(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "media_bytes", "media_sha256")


# A file is the header of 44 bytes of 8-bit mono at 8000 Hz, sizes low byte first, and the payload.
MEDIA_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, length(h) // 2 AS n, greatest(1, ceil(length(h) / 128.0))::BIGINT * 64 AS m, h FROM d),
q AS (SELECT doc_id, n, m, h || repeat('00', (m - n)::INT) AS x, printf('%08x', m) AS s, printf('%08x', m + 36) AS z FROM p),
f AS (SELECT *, '52494646' || z[7:8] || z[5:6] || z[3:4] || z[1:2] || '57415645666d74201000000001000100401f0000401f00000100080064617461' || s[7:8] || s[5:6] || s[3:4] || s[1:2] || x AS w FROM q)
SELECT doc_id, n AS n_bytes, m AS payload_bytes, sha256(unhex(x)) AS payload_sha256, m + 44 AS media_bytes, sha256(unhex(w)) AS media_sha256 FROM f"""


def decoded_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of what operator 7's ids decode to: that of the text."""
    return bpe.op7_byte_bpe(spark, sf_dir).select("doc_id", "decoded_sha256")


DECODED_SQL = "SELECT doc_id, sha256(coalesce(text, '')) AS decoded_sha256 FROM documents"


def secret_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10's base finds of each kind."""
    return secret_scan.op10_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


SECRET_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, len(list_filter(regexp_extract_all(t, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2), lambda x: length(x) >= 8)) AS n_assign,
  len(list_filter(regexp_extract_all(t, 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 16)) AS n_access, len(list_filter(regexp_extract_all(t, '[0-9a-f]+'), lambda x: length(x) >= 32)) AS n_hex FROM d"""

#: Operator 5 by comparing all strings of 200 bytes, for tables of a few megabytes; hexadecimal digits in twos are bytes.
REPEATS_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS k FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM d) t),
s AS (SELECT r, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
g AS (SELECT r, i, i > 200 + coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -1000) AS new FROM s),
runs AS (SELECT r, min(i) AS a, max(i) + 200 AS z FROM (SELECT r, i, sum(new::INT) OVER (PARTITION BY r ORDER BY i) AS n FROM g) t GROUP BY r, n),
cut AS (SELECT r, sum(z - a)::BIGINT AS n, count(*) AS m FROM runs GROUP BY r),
edges AS (SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS x, a AS y FROM runs UNION ALL SELECT r, max(z), NULL FROM runs GROUP BY r),
kept AS (SELECT d.r, string_agg(CASE WHEN y IS NULL THEN substr(h, 2 * x + 1) ELSE substr(h, 2 * x + 1, 2 * (y - x)) END, '' ORDER BY x) AS h FROM edges JOIN d ON d.r = edges.r GROUP BY d.r)
SELECT doc_id, length(d.h) // 2 AS n_bytes, coalesce(n, 0) AS n_removed, coalesce(m, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256 FROM d LEFT JOIN cut USING (r) LEFT JOIN kept USING (r)"""

QUERIES = {f.__name__: f for f in (quality_base_counts, media_sizes, decoded_digests, secret_base_counts)}
ORACLES = {"quality_base_counts": BASE_SQL, "media_sizes": MEDIA_SQL, "decoded_digests": DECODED_SQL, "secret_base_counts": SECRET_SQL, "op5_suffix_dedup": REPEATS_SQL}
