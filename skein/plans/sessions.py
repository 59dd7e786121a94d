"""Catalog queries, packing and summaries on stand-ins: orders as sessions, line items as clips, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import ids, text
from skein.operators import catalog, grouping, summary
from skein.plans.tables import joined, table

VERSION_FLAG = "R"


def resume_anti(spark: SparkSession, d: str) -> DataFrame:
    """The first 200 documents that are not finished: labelled, with as many distinct chunks as their label says."""
    docs, labels = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels")
    markers = labels.select("doc_id", (F.col("quality") + 1).alias("expected"))
    chunks = labels.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("toxic"))).alias("idx"))
    return catalog.resumed(docs, catalog.finished_sessions(markers, chunks, "doc_id", "expected", "idx"), "doc_id", 200)


RESUME_SQL = """SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic + 1 = l.quality + 1) ORDER BY doc_id LIMIT 200"""


def sessions_not_clipped(spark: SparkSession, d: str) -> DataFrame:
    """Orders without a returned line item: sessions not yet clipped for a version."""
    done = table(spark, d, "lineitem").filter(F.col("l_returnflag") == VERSION_FLAG).select(F.col("l_orderkey").alias("o_orderkey"))
    return catalog.not_done(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), done, ["o_orderkey"])


NOT_CLIPPED_SQL = "SELECT o_orderkey, o_orderstatus FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')"


def caption_tasks(spark: SparkSession, d: str) -> DataFrame:
    """Line items of two cameras with their sessions, in orders without a returned item."""
    spans = table(spark, d, "lineitem").filter(F.col("l_linenumber").isin(1, 2)).select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    sessions = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    done = table(spark, d, "lineitem").filter(F.col("l_returnflag") == VERSION_FLAG).select(F.col("l_orderkey").alias("o_orderkey"))
    return catalog.not_done(spans.join(sessions, "o_orderkey"), done, ["o_orderkey"])


CAPTION_TASKS_SQL = """SELECT o_orderkey, l_linenumber, l_partkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_linenumber IN (1, 2) AND NOT EXISTS (SELECT 1 FROM lineitem x WHERE x.l_orderkey = o_orderkey AND x.l_returnflag = 'R')"""


def trajectory_tasks(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of urgent orders of one market segment with their clips as arrays in line order."""
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'"), F.col("o_custkey") == F.col("c_custkey"))
    done = table(spark, d, "lineitem").filter("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey"))
    rows = catalog.not_done(rows, done, ["o_orderkey"])
    made = catalog.ordered_arrays(rows, ["o_orderkey"], "l_linenumber", ["l_partkey", "l_suppkey"])
    return made.select("o_orderkey", joined(F.col("l_linenumbers")).alias("lines"), joined(F.col("l_partkeys")).alias("parts"), joined(F.col("l_suppkeys")).alias("supps"))


TRAJECTORY_SQL = """SELECT o_orderkey, array_to_string(list(l_linenumber ORDER BY l_linenumber, l_partkey, l_suppkey), ',') AS lines, array_to_string(list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey), ',') AS parts, array_to_string(list(l_suppkey ORDER BY l_linenumber, l_partkey, l_suppkey), ',') AS supps
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority = '1-URGENT' AND c_mktsegment = 'BUILDING'
AND NOT EXISTS (SELECT 1 FROM lineitem x WHERE x.l_orderkey = o_orderkey AND x.l_returnflag = 'A') GROUP BY o_orderkey"""


def sharding_tasks(spark: SparkSession, d: str) -> DataFrame:
    """Complete sessions: clips of cameras 1 and 2 at least, arrays in camera order, every clip with two windows."""
    rows = table(spark, d, "lineitem").join(table(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.withColumn("windows", F.when(F.col("l_quantity") > 2, F.array("p_brand", "l_returnflag")).otherwise(F.array("p_brand")))
    made = catalog.ordered_arrays(rows, ["l_orderkey"], "l_linenumber", ["l_partkey", "windows"])
    cams = F.col("l_linenumbers")
    fits = catalog.complete(F.size(cams), [F.col("l_partkeys")], cams, [1, 2], F.col("windowss"))
    return made.filter(fits).select("l_orderkey", F.size(cams).cast("long").alias("n_clips"), joined(cams).alias("cameras"), joined(F.col("l_partkeys")).alias("clips"))


SHARDING_SQL = """SELECT l_orderkey, count(*) AS n_clips, array_to_string(list(l_linenumber ORDER BY l_linenumber, l_partkey), ',') AS cameras, array_to_string(list(l_partkey ORDER BY l_linenumber, l_partkey), ',') AS clips
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey HAVING bool_and(l_quantity > 2) AND bool_or(l_linenumber = 1) AND bool_or(l_linenumber = 2)"""


def trajectory_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Each order's parts looked up in their places; parts of even size are missing from the table."""
    made = catalog.ordered_arrays(table(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber", ["l_partkey"])
    parts = table(spark, d, "part").filter("p_size % 2 = 1").select(F.col("p_partkey").alias("id"), "p_brand")
    found = catalog.looked_up(made, ["l_orderkey"], "l_partkeys", parts, "id", "p_brand")
    return found.select("l_orderkey", F.array_join(F.transform("values", lambda v: F.coalesce(v, F.lit("-"))), ",").alias("brands"))


LOOKUP_SQL = """SELECT l_orderkey, array_to_string(list(coalesce(p_brand, '-') ORDER BY l_linenumber, l_partkey), ',') AS brands
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_size % 2 = 1 GROUP BY l_orderkey"""


def camera_order(spark: SparkSession, d: str) -> DataFrame:
    """Pages of each host with those of a keyword first, then by address."""
    pages = table(spark, d, "pages").select(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"), "url").distinct()
    return catalog.primary_first(pages, "host", "url", "1", strict=False)


CAMERA_SQL = """SELECT host, url, row_number() OVER (PARTITION BY host ORDER BY CASE WHEN contains(url, '1') THEN 0 ELSE 1 END, url) - 1 AS camera_rank
FROM (SELECT DISTINCT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, url FROM pages) t"""


def camera_alignment(spark: SparkSession, d: str) -> DataFrame:
    """(order, line) clips whose spans differ between the two return flags' cameras."""
    clips = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("session"), "l_linenumber", F.col("l_returnflag").alias("camera"), F.floor(F.col("l_quantity") / 25).alias("start"))
    return catalog.misaligned(clips, "session", "l_linenumber", "camera", ["start"])


ALIGNMENT_SQL = """WITH c AS (SELECT l_suppkey AS session, l_linenumber, l_returnflag AS camera, floor(l_quantity / 25) AS s FROM lineitem),
a AS (SELECT session, count(DISTINCT camera) AS n FROM c GROUP BY session), e AS (SELECT session, l_linenumber, count(DISTINCT s) AS k, count(DISTINCT camera) AS m FROM c GROUP BY 1, 2)
SELECT session, l_linenumber FROM e JOIN a USING (session) WHERE k > 1 OR m < n"""


def parent_dir_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").groupBy(text.parent_folder(F.col("url")).alias("folder")).agg(F.count("*").alias("n_files"))


PARENT_SQL = "SELECT regexp_replace(url, '/[^/]*$', '') AS folder, count(*) AS n_files FROM pages GROUP BY 1"


def pack_tars(spark: SparkSession, d: str) -> DataFrame:
    """Documents of each source packed by bytes into tars of 20,000, small last ones dropped, numbered in parts of 3."""
    docs = table(spark, d, "documents").select("source", "doc_id", "n_chars")
    groups = grouping.drop_small_last(grouping.packed(docs, "source", ["doc_id"], "n_chars", 20_000), "source", 2)
    sums = groups.groupBy("source", "group_no").agg(F.count("*").alias("n_keys"), F.sum("n_chars").alias("n_bytes"))
    existing = table(spark, d, "documents").filter("doc_id % 5 = 0").groupBy("source").agg(F.min(F.col("doc_id") % 7).alias("part"))
    made = grouping.numbered_parts(sums, "source", existing, 3)
    return made.select("source", "n_keys", "n_bytes", F.concat_ws("/", ids.part_path(F.col("part")), ids.tar_path(F.col("tar"))).alias("path"))


PACK_SQL = """WITH RECURSIVE o AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
p AS (SELECT source, rn, n_chars, n_chars AS so_far, 0 AS g FROM o WHERE rn = 1
  UNION ALL SELECT o.source, o.rn, o.n_chars, CASE WHEN p.so_far + o.n_chars > 20000 THEN o.n_chars ELSE p.so_far + o.n_chars END, p.g + CASE WHEN p.so_far + o.n_chars > 20000 THEN 1 ELSE 0 END
  FROM p JOIN o ON o.source = p.source AND o.rn = p.rn + 1),
s AS (SELECT source, g, count(*) AS n_keys, sum(n_chars)::BIGINT AS n_bytes, max(g) OVER (PARTITION BY source) AS last FROM p GROUP BY source, g),
e AS (SELECT source, min(doc_id % 7) AS part FROM documents WHERE doc_id % 5 = 0 GROUP BY source)
SELECT source, n_keys, n_bytes, 'part_' || lpad((coalesce(part, -1) + 1 + g // 3)::VARCHAR, 6, '0') || '/' || lpad((g % 3)::VARCHAR, 6, '0') || '.tar' AS path
FROM s LEFT JOIN e USING (source) WHERE NOT (g = last AND n_keys < 2)"""


def chunk_close_on_reach(spark: SparkSession, d: str) -> DataFrame:
    """Documents of each language in chunks that close once they reach 10,000 characters."""
    made = grouping.closed_on_reach(table(spark, d, "documents").select("lang", "doc_id", "n_chars"), "lang", ["doc_id"], "n_chars", 10_000)
    return made.groupBy("lang", "group_no").agg(F.count("*").alias("n_rows"), F.sum("n_chars").alias("n_bytes"), F.min("doc_id").alias("first_id"))


CHUNK_SQL = """WITH RECURSIVE o AS (SELECT lang, doc_id, n_chars, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents),
p AS (SELECT lang, doc_id, rn, n_chars, n_chars AS so_far, 0 AS g FROM o WHERE rn = 1
  UNION ALL SELECT o.lang, o.doc_id, o.rn, o.n_chars, CASE WHEN p.so_far >= 10000 THEN o.n_chars ELSE p.so_far + o.n_chars END, p.g + CASE WHEN p.so_far >= 10000 THEN 1 ELSE 0 END
  FROM p JOIN o ON o.lang = p.lang AND o.rn = p.rn + 1)
SELECT lang, g::BIGINT AS group_no, count(*) AS n_rows, sum(n_chars)::BIGINT AS n_bytes, min(doc_id) AS first_id FROM p GROUP BY lang, g"""


def near_equal_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Customers by key in seven chunks of nearly equal size."""
    made = grouping.near_equal(table(spark, d, "customer").select("c_custkey"), ["c_custkey"], 7)
    return made.groupBy("chunk").agg(F.count("*").alias("n_rows"), F.min("c_custkey").alias("lo"), F.max("c_custkey").alias("hi"))


EQUAL_SQL = "SELECT (k - 1)::BIGINT AS chunk, count(*) AS n_rows, min(c_custkey) AS lo, max(c_custkey) AS hi FROM (SELECT c_custkey, ntile(7) OVER (ORDER BY c_custkey) AS k FROM customer) t GROUP BY k"


def caption_chain(spark: SparkSession, d: str) -> DataFrame:
    """Turns of a conversation as a caption chain, the newest first, with numbered prompt types."""
    made = summary.caption_chain(table(spark, d, "conversations"), ["conv_id"], "turn", "text", "visibility")
    return made.select("conv_id", "prompt_type", F.md5("text").alias("digest"))


CHAIN_SQL = """SELECT conv_id, CASE WHEN r = 1 THEN 'visibility' ELSE 'visibility_' || lpad((r - 2)::VARCHAR, 3, '0') END AS prompt_type, md5(text) AS digest
FROM (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) AS r FROM conversations) t"""


def even_chains(spark: SparkSession, d: str) -> DataFrame:
    """Conversations whose roles all have equally many turns."""
    return summary.even_chains(table(spark, d, "conversations"), "conv_id", "role")


EVEN_SQL = "SELECT conv_id, max(n) AS chain FROM (SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY 1, 2) t GROUP BY conv_id HAVING min(n) = max(n)"


def captions_doc(spark: SparkSession, d: str) -> DataFrame:
    """Every conversation as a document of clips (roles) and windows (turns); of each its entries and last text."""
    rows = table(spark, d, "conversations").withColumn("v", F.length("text"))
    made = summary.captions_document(rows, "conv_id", "role", "turn", "text", "v")
    entry = F.explode("captions").alias("clip", "windows")
    return made.select("conv_id", entry).select("conv_id", "clip", F.size("windows").cast("long").alias("n_windows"), F.md5(F.array_join(F.array_sort(F.map_values("windows")), "|")).alias("digest"))


DOC_SQL = """SELECT conv_id, role AS clip, count(*) AS n_windows, md5(string_agg(t, '|' ORDER BY t)) AS digest FROM (
  SELECT conv_id, role, turn, arg_max(text, length(text)) AS t FROM conversations GROUP BY ALL) x GROUP BY conv_id, role"""


def stage_perf(spark: SparkSession, d: str) -> DataFrame:
    """Counters of a map from event type to number, added up by type."""
    ev = table(spark, d, "events").select(F.create_map("event_type", F.lit(1), F.concat("event_type", F.lit("_chars")), F.length("props")).alias("m"))
    return summary.stage_counters(ev, "m")


PERF_SQL = "SELECT event_type AS stage, count(*) AS total FROM events GROUP BY 1 UNION ALL SELECT event_type || '_chars', sum(length(props))::BIGINT FROM events GROUP BY 1"


def av_session_summary(spark: SparkSession, d: str) -> DataFrame:
    """Orders as sessions: line items in chunk order, the duration from the first one only."""
    chunks = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.array_sort(F.collect_list("l_partkey")).alias("clips"), F.min("l_quantity").alias("seconds"))
    made = summary.session_clips(chunks.withColumn("idx", F.col("l_linenumber") - 1), "l_orderkey", "idx", "clips", "seconds")
    return made.select("l_orderkey", joined(F.col("clips")).alias("clips"), "seconds")


AV_SQL = """SELECT l_orderkey, array_to_string(list(l_partkey ORDER BY l_linenumber, l_partkey), ',') AS clips, min(l_quantity) FILTER (l_linenumber = 1) AS seconds
FROM lineitem GROUP BY l_orderkey"""


def completion_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Inputs, finished ones and percent by (region, nation), region and in total."""
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    made = summary.completion(rows.withColumn("done", F.col("c_acctbal") > 0), "n_regionkey", "n_name", "done")
    return made.select("n_regionkey", "n_name", "level", "inputs", "outputs", "left_over", "percent")


COMPLETION_SQL = """SELECT n_regionkey, n_name, CASE WHEN grouping(n_name) = 0 THEN 'folder' WHEN grouping(n_regionkey) = 0 THEN 'root' ELSE 'total' END AS level,
  count(*) AS inputs, count(*) FILTER (c_acctbal > 0) AS outputs, count(*) - count(*) FILTER (c_acctbal > 0) AS left_over, round(100.0 * count(*) FILTER (c_acctbal > 0) / count(*)::DOUBLE, 4) AS percent
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_regionkey, n_name)"""


def catalog_rows(spark: SparkSession, d: str) -> DataFrame:
    """Span rows for the catalog: name-based id, content digest, image id."""
    docs = table(spark, d, "documents")
    return docs.select("doc_id", ids.uuid5(F.col("text")).alias("span_uuid"), F.sha2("text", 256).alias("sha256"), ids.image_id(F.col("source")).alias("image_id"))


def _catalog_sql() -> str:
    from skein.plans.cutting import _uuid_sql

    return f"SELECT doc_id, {_uuid_sql('text')} AS span_uuid, sha256(text) AS sha256, left(sha256(source), 16) AS image_id FROM documents"


def top_profile(spark: SparkSession, d: str) -> DataFrame:
    """Report of the 20 dearest orders."""
    return summary.top_rows(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 20)


def schema_evolution(spark: SparkSession, d: str) -> DataFrame:
    """Parts under a changed schema, beside the changes that lead to it."""
    parts = table(spark, d, "part").select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name", F.col("p_size").cast("int").alias("p_size"))
    want = {"p_partkey": "bigint", "p_size": "bigint", "note": "string"}
    changes = ";".join(" ".join(c) for c in sorted(catalog.schema_changes(dict(parts.dtypes), want)))
    return catalog.evolved(parts, want).withColumn("changes", F.lit(changes))


EVOLUTION_SQL = "SELECT p_partkey::BIGINT AS p_partkey, p_size::BIGINT AS p_size, NULL::VARCHAR AS note, 'add note string;alter p_size bigint;drop p_name string' AS changes FROM part"


def cascaded_delete(spark: SparkSession, d: str) -> DataFrame:
    """Customers of one nation deleted with their orders and line items: what is left, and what then names no parent."""
    tables = {
        "customer": table(spark, d, "customer").select(F.col("c_custkey").alias("cust"), "c_nationkey"),
        "orders": table(spark, d, "orders").select(F.col("o_orderkey").alias("ord"), F.col("o_custkey").alias("cust")),
        "lineitem": table(spark, d, "lineitem").select(F.col("l_orderkey").alias("ord"), "l_linenumber"),
    }
    gone = tables["customer"].filter("c_nationkey = 3").select("cust")
    left = catalog.deleted(tables, [("orders", "customer", "cust"), ("lineitem", "orders", "ord")], "customer", "cust", gone)
    counts = [left[t].agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("name"), "n_rows") for t in left]
    counts.append(catalog.orphans(left["orders"], left["customer"], "cust").agg(F.count("*").alias("n_rows")).select(F.lit("orphans").alias("name"), "n_rows"))
    counts.append(catalog.orphans(tables["orders"], left["customer"], "cust").agg(F.count("*").alias("n_rows")).select(F.lit("orphans before").alias("name"), "n_rows"))
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3]).union(counts[4])


CASCADE_SQL = """WITH c AS (SELECT c_custkey AS k FROM customer WHERE c_nationkey <> 3 OR c_nationkey IS NULL), g AS (SELECT c_custkey AS k FROM customer WHERE c_nationkey = 3), o AS (SELECT o_orderkey AS k FROM orders WHERE o_custkey NOT IN (SELECT k FROM g)), go AS (SELECT o_orderkey AS k FROM orders WHERE o_custkey IN (SELECT k FROM g))
SELECT 'customer' AS name, count(*) AS n_rows FROM c UNION ALL SELECT 'orders', count(*) FROM o UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT k FROM go)
UNION ALL SELECT 'orphans', (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) UNION ALL SELECT 'orphans before', (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT k FROM c))"""


def profile_fold(spark: SparkSession, d: str) -> DataFrame:
    """Event types by user as call stacks of profiling sessions, folded over all sessions."""
    ev = table(spark, d, "events").groupBy("user_id", F.concat_ws(";", F.lit("main"), "event_type").alias("stack")).agg(F.count("*").alias("samples"))
    return summary.folded_profiles(ev, "stack", "samples")


FOLD_SQL = "SELECT 'main;' || event_type AS stack, count(*) AS samples, round(count(*) / (SELECT count(*) FROM events)::DOUBLE, 6) AS share, 2::BIGINT AS depth FROM events GROUP BY event_type"


QUERIES = {f.__name__: f for f in (schema_evolution, cascaded_delete, profile_fold, resume_anti, sessions_not_clipped, caption_tasks, trajectory_tasks, sharding_tasks, trajectory_lookup, camera_order, camera_alignment, parent_dir_counts, pack_tars, chunk_close_on_reach, near_equal_chunks, caption_chain, even_chains, captions_doc, stage_perf, av_session_summary, completion_rollup, catalog_rows, top_profile)}
ORACLES = {
    "schema_evolution": EVOLUTION_SQL,
    "cascaded_delete": CASCADE_SQL,
    "profile_fold": FOLD_SQL,
    "resume_anti": RESUME_SQL,
    "sessions_not_clipped": NOT_CLIPPED_SQL,
    "caption_tasks": CAPTION_TASKS_SQL,
    "trajectory_tasks": TRAJECTORY_SQL,
    "sharding_tasks": SHARDING_SQL,
    "trajectory_lookup": LOOKUP_SQL,
    "camera_order": CAMERA_SQL,
    "camera_alignment": ALIGNMENT_SQL,
    "parent_dir_counts": PARENT_SQL,
    "pack_tars": PACK_SQL,
    "chunk_close_on_reach": CHUNK_SQL,
    "near_equal_chunks": EQUAL_SQL,
    "caption_chain": CHAIN_SQL,
    "even_chains": EVEN_SQL,
    "captions_doc": DOC_SQL,
    "stage_perf": PERF_SQL,
    "av_session_summary": AV_SQL,
    "completion_rollup": COMPLETION_SQL,
    "catalog_rows": _catalog_sql(),
    "top_profile": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
}
