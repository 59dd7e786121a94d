"""Queries that go through files: what is written below a shared folder is read back, and their SQL."""

from __future__ import annotations

import sqlite3

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import blobs, ids, text
from skein.operators import frames, records, spans
from skein.plans.cutting import _uuid_sql
from skein.plans.tables import joined, micros, table
from skein.session import shared_folder
from skein.sources import files, fragments, images, mcap, packages, packets, sinks, sqlite
from skein.streaming import arrivals


def _tree(spark: SparkSession, d: str) -> str:
    """A folder with a file for each nation in its region's folder."""
    nations = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    base = shared_folder(spark, "tree")
    rows = nations.select(F.concat(ids.uuid5("r_name"), F.lit("/"), F.replace("n_name", F.lit(" "), F.lit("_")), F.when(F.col("n_nationkey") % 2 == 0, ".mp4").otherwise(".JSON")).alias("path"), F.encode(F.to_json(F.struct("n_name", "n_nationkey")), "utf-8").alias("content"))
    sinks.write_files(rows, base)
    return base


TREE = f"""t AS (SELECT {_uuid_sql('r_name')} AS folder, replace(n_name, ' ', '_') AS name, n_nationkey % 2 = 0 AS video, '{{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || '}}' AS body FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def file_listing(spark: SparkSession, d: str) -> DataFrame:
    """Files of one extension below a folder, whatever its letters' case, with their relative paths and sizes."""
    return files.listed(spark, _tree(spark, d), "json").select("relative", "length")


LISTING_SQL = f"WITH {TREE} SELECT folder || '/' || name || '.JSON' AS relative, length(body)::BIGINT AS length FROM t WHERE NOT video"


def session_files(spark: SparkSession, d: str) -> DataFrame:
    """Sessions (folders named by a UUID) with their videos, and how many files and top folders there are."""
    found = files.listed(spark, _tree(spark, d))
    videos = files.sessions(found).groupBy("session").agg(F.count("*").alias("n_videos"))
    parents = files.parent_counts(found.withColumn("path", F.col("relative"))).withColumnRenamed("folder", "session")
    return files.top_folders(found).withColumnRenamed("folder", "session").join(parents, "session").join(videos, "session", "left").select("session", "n_files", F.coalesce("n_videos", F.lit(0)).cast("long").alias("n_videos"))


SESSION_SQL = f"WITH {TREE} SELECT folder AS session, count(*) AS n_files, count(*) FILTER (video) AS n_videos FROM t GROUP BY folder"


def retried_reads(spark: SparkSession, d: str) -> DataFrame:
    """Contents of files, and the errors of those that are not there or no JSON, after a bounded number of attempts."""
    base = _tree(spark, d)
    wanted = files.listed(spark, base).select("relative").unionByName(spark.range(2).select(F.concat(F.lit("gone-"), F.col("id")).alias("relative")))
    paths = wanted.select("relative", F.concat(F.lit(f"{base}/"), F.col("relative")).alias("path"))
    return files.read(paths, attempts=2, kind="json").select("relative", F.col("content").alias("body"), F.col("errors")["read"].alias("error"))


READS_SQL = f"WITH {TREE} SELECT folder || '/' || name || CASE WHEN video THEN '.mp4' ELSE '.JSON' END AS relative, body, NULL::VARCHAR AS error FROM t UNION ALL SELECT 'gone-' || i, NULL, 'FileNotFoundError' FROM range(2) r(i)"


def input_lists(spark: SparkSession, d: str) -> DataFrame:
    """Paths of a JSON array relative to their prefix, and sessions of a list of lines."""
    base = shared_folder(spark, "lists")
    nations = table(spark, d, "nation").select(F.concat(F.lit("s3://in/v/"), F.col("n_regionkey").cast("string"), F.lit("/"), F.col("n_nationkey").cast("string"), F.lit(".mp4")).alias("p"))
    lists = nations.agg(F.array_sort(F.collect_list("p")).alias("p"))  # 25 rows
    sinks.write_files(lists.select(F.inline(F.array(F.struct(F.lit("a.json").alias("path"), F.encode(F.to_json("p"), "utf-8").alias("content")), F.struct(F.lit("b.txt").alias("path"), F.encode(F.concat(F.array_join("p", "\n"), F.lit("\nnoise\n")), "utf-8").alias("content"))))), base)
    one = files.input_list(spark, f"{base}/a.json", "s3://in/v").select(F.lit("input").alias("kind"), F.col("relative").alias("value"))
    return one.unionByName(files.session_file(spark, f"{base}/b.txt").select(F.lit("session").alias("kind"), F.col("session").alias("value")))


LISTS_SQL = "SELECT 'input' AS kind, n_regionkey || '/' || n_nationkey || '.mp4' AS value FROM nation UNION ALL SELECT DISTINCT 'session', 's3://in/v/' || n_regionkey FROM nation"


def clip_metadata_rows(spark: SparkSession, d: str) -> DataFrame:
    """Metadata of suppliers as clips, a JSON file each, read back by the schema: the valid ones."""
    base = shared_folder(spark, "metas")
    clips = table(spark, d, "supplier").select(ids.uuid5("s_name").alias("span_uuid"), F.lit("v").alias("source_video"), F.array(F.lit(0.0), F.col("s_suppkey") / 2.0).alias("duration_span"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_suppkey").cast("int")).alias("width"), (F.col("s_suppkey") % 3 > 0).alias("valid"))
    made = records.metadata_json(clips, "span_uuid", ["span_uuid", "source_video", "duration_span", "width", "valid"])
    sinks.write_files(made.select(F.concat("span_uuid", F.lit(".json")).alias("path"), F.encode("json", "utf-8").alias("content")), base)
    return files.clip_metadata(spark, base).select("span_uuid", F.element_at("duration_span", -1).alias("seconds"), "width")


METADATA_SQL = f"SELECT {_uuid_sql('s_name')} AS span_uuid, s_suppkey / 2.0::DOUBLE AS seconds, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey END::INT AS width FROM supplier WHERE s_suppkey % 3 > 0"


def embedding_files(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings written by cluster, listed by suffix and read back pruned to id and vector."""
    base = shared_folder(spark, "vectors")
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label", F.lit("unread").alias("more"))
    sinks.write(rows, base, partition_by=["label"])
    listed = files.parquet_files(spark, base).select(text.parent_folder(F.col("relative")).alias("folder")).distinct()
    read = files.embeddings(spark, None, base).select("id", F.size("embedding").cast("long").alias("n"))
    return read.select(F.lit("row").alias("kind"), F.col("id").cast("string").alias("value"), "n").unionByName(listed.select(F.lit("folder").alias("kind"), F.col("folder").alias("value"), F.lit(0).cast("long").alias("n")))


EMBEDDING_SQL = "SELECT 'row' AS kind, vec_id::VARCHAR AS value, len(embedding) AS n FROM embeddings UNION ALL SELECT DISTINCT 'folder', 'label=' || label, 0 FROM embeddings"


def saved_tasks(spark: SparkSession, d: str) -> DataFrame:
    """Tasks of a stage saved as Parquet and scanned again for a replay, items given in the program beside them."""
    base = shared_folder(spark, "tasks")
    records.sampled(table(spark, d, "part").select("p_partkey", "p_size"), "p_partkey", 1.0).write.parquet(base)
    items = spark.createDataFrame([(-1, 0), (-2, 1)], "p_partkey long, p_size int")
    return spark.read.parquet(base).select(F.col("p_partkey").cast("long").alias("p_partkey"), F.col("p_size").cast("int").alias("p_size")).unionByName(items)


SAVED_SQL = "SELECT p_partkey::BIGINT AS p_partkey, p_size::INT AS p_size FROM part UNION ALL VALUES (-1::BIGINT, 0::INT), (-2, 1)"


def sqlite_rows(spark: SparkSession, d: str) -> DataFrame:
    """A SQLite table of the nations through the data source; the file lies in a local shared folder."""
    base = shared_folder(spark, "db")
    sinks.write_files(spark.createDataFrame([("empty", bytearray())], "path string, content binary"), base)
    path = f"{base}/t.db".removeprefix("file:")
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE trajectory (nation INTEGER, name TEXT)")
        con.executemany("INSERT INTO trajectory VALUES (?, ?)", [tuple(r) for r in table(spark, d, "nation").select("n_nationkey", "n_name").collect()])  # 25 rows
    sqlite.register(spark)
    return spark.read.format("skein_sqlite").schema("name string, nation long").option("path", path).option("table", "trajectory").option("partitions", "3").load()


def mcap_messages(spark: SparkSession, d: str) -> DataFrame:
    """Each user's events as a recording, scanned for a range of log times."""
    base = shared_folder(spark, "recordings")
    ev = table(spark, d, "events").select("user_id", (micros("ts") * 1000).alias("t"), F.encode("event_type", "utf-8").alias("p"))
    sinks.write_files(mcap.recorded(ev, "user_id", "/events", "t", "p"), base)
    found = mcap.scanned(spark, base, "/events", 1_705_000_000_000_000_000, 1_706_000_000_000_000_000)
    return found.select(F.regexp_extract("file", r"(\d+)\.mcap$", 1).cast("long").alias("user_id"), "log_time_ns", F.decode("data", "utf-8").alias("event_type"))


MCAP_SQL = "SELECT user_id::BIGINT AS user_id, epoch_us(ts) * 1000 AS log_time_ns, event_type FROM events WHERE epoch_us(ts) >= 1705000000000000 AND epoch_us(ts) < 1706000000000000"


def session_stamps(spark: SparkSession, d: str) -> DataFrame:
    """Frame times of lines of text: bad lines are left out, camera numbers mapped."""
    lines = table(spark, d, "lineitem").select(F.when(F.col("l_linenumber") == 3, "broken").otherwise(F.concat(F.col("l_linenumber").cast("string"), F.lit(", "), F.col("l_orderkey").cast("string"))).alias("value"))
    return mcap.session_timestamps(lines, {1: 10, 2: 20, 4: 40}).groupBy("camera").agg(F.count("*").alias("n"), F.max("ms").alias("last"))


STAMPS_SQL = "SELECT (l_linenumber * 10)::INT AS camera, count(*) AS n, max(l_orderkey)::BIGINT AS last FROM lineitem WHERE l_linenumber IN (1, 2, 4) GROUP BY l_linenumber"


#: Bytes from which on an archive of the round trip is closed.
ARCHIVE_BYTES = 16 << 20


def archive_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Documents in archives by language and source, as many as their bytes ask for, read back: members grouped by key,
    contents by digest. A document without text has no such member and an empty length."""
    base = shared_folder(spark, "archives")
    none = F.lit("none")
    docs = table(spark, d, "documents").select(F.concat(F.coalesce("lang", none), F.lit("/"), F.coalesce("source", none), F.lit(".tar")).alias("p"), F.col("doc_id").cast("string").alias("k"), "text")
    member = lambda suffix, x: F.struct(F.concat("k", F.lit(suffix)).alias("n"), F.encode(x, "utf-8").alias("x"))
    both = F.array(member(".txt", F.col("text")), member(".len", F.coalesce(F.length("text").cast("string"), F.lit(""))))
    each = docs.select("p", F.inline(F.filter(both, lambda m: m["x"].isNotNull())))
    sinks.write_files(sinks.archives(each, "p", "n", "x", ARCHIVE_BYTES), base)
    read = files.archive_samples(spark, base)
    return read.select(F.col("key").cast("long").alias("doc_id"), F.md5(F.col("data")["txt"]).alias("digest"), F.nullif(F.decode(F.col("data")["len"], "utf-8"), F.lit("")).cast("long").alias("n"))


ARCHIVE_SQL = "SELECT doc_id, md5(text) AS digest, length(text) AS n FROM documents"


def sink_formats(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers in each format: a second write that keeps the old, one that overwrites, one that backs up; what is there then."""
    base, out = shared_folder(spark, "formats"), None
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").cast("long").alias("k"), "s_name")
    for kind in ("parquet", "json", "csv"):
        path = f"{base}/{kind}"
        sinks.write(rows, path, kind)
        sinks.write(rows.limit(1), path, kind)
        sinks.write(rows.filter("k % 2 = 0"), path, kind, sinks.OVERWRITE, one_file=True)
        sinks.write(rows.filter("k % 2 = 1"), path, kind, sinks.BACKUP)
        for name, at in (("now", path), ("before", f"{path}.bak-0")):
            reader = spark.read.schema("k long, s_name string").option("header", "true")
            part = reader.format(kind).load(at).select(F.lit(kind).alias("kind"), F.lit(name).alias("version"), "k", "s_name")
            out = part if out is None else out.unionByName(part)
    return out


FORMATS_SQL = "SELECT kind, CASE WHEN s_suppkey % 2 = 1 THEN 'now' ELSE 'before' END AS version, s_suppkey::BIGINT AS k, s_name FROM supplier, (VALUES ('parquet'), ('json'), ('csv')) v(kind)"


def routed_clips(spark: SparkSession, d: str) -> DataFrame:
    """Kept and rejected documents written to folders of their own from one pass, and read back."""
    base = shared_folder(spark, "routes")
    sinks.routed(table(spark, d, "documents").select("doc_id", F.when(F.col("n_chars") < 500, "motion").alias("stage_rejected")), base)
    return spark.read.parquet(base).groupBy("route").agg(F.count("*").alias("n_rows"), F.sum("doc_id").alias("checksum"))


ROUTED_SQL = "SELECT CASE WHEN n_chars < 500 THEN 'filtered_clips' ELSE 'clips' END AS route, count(*) AS n_rows, sum(doc_id)::BIGINT AS checksum FROM documents GROUP BY 1"


def committed_fragments(spark: SparkSession, d: str) -> DataFrame:
    """Parts staged as fragments in two runs and committed twice, and keys appended twice: each row is there once."""
    base = shared_folder(spark, "fragments")
    parts = table(spark, d, "part").select("p_partkey", "p_name")
    for k in range(2):
        fragments.stage(parts.filter(F.col("p_partkey") % 2 == k), f"{base}/staging", f"run-{k}")
        fragments.consolidated(spark, f"{base}/staging", f"{base}/processed", f"{base}/final")
    fragments.stage(parts, f"{base}/staging", "run-1")
    fragments.consolidated(spark, f"{base}/staging", f"{base}/processed", f"{base}/final")
    for _ in range(2):
        sinks.append_new(parts.filter("p_partkey % 3 = 0"), f"{base}/appended", "p_partkey")
    final = spark.read.parquet(f"{base}/final").withColumn("way", F.lit("fragments"))
    return final.unionByName(spark.read.parquet(f"{base}/appended").withColumn("way", F.lit("appended")))


FRAGMENTS_SQL = "SELECT p_partkey, p_name, 'fragments' AS way FROM part UNION ALL SELECT p_partkey, p_name, 'appended' FROM part WHERE p_partkey % 3 = 0"


def vector_store_rows(spark: SparkSession, d: str) -> DataFrame:
    """Vectors with captions as a vector store takes them."""
    rows = table(spark, d, "embeddings").select("vec_id", "embedding", F.array(F.concat(F.lit("a "), F.col("label").cast("string")), F.lit('say "b"')).alias("captions"))
    made = sinks.vector_rows(rows, "vec_id", "embedding", "captions")
    return made.select("id", F.size("embedding").cast("long").alias("n"), F.col("$meta").alias("meta"))


VECTOR_SQL = """SELECT vec_id AS id, len(embedding) AS n, '{"caption":"a ' || label || ' | say \\"b\\""}' AS meta FROM embeddings"""


def annotation_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Orders' line items under one name as JSON, a list each, written one a file, with their markers, and read back."""
    base = shared_folder(spark, "annotations")
    items = table(spark, d, "lineitem").filter("l_orderkey <= 200").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part")))).alias("i"))
    made = items.select(F.concat(F.col("l_orderkey").cast("string"), F.lit(".json")).alias("path"), F.encode(records.envelope("items", F.col("i")), "utf-8").alias("content"))
    sinks.write_files(made, f"{base}/annotations")
    sinks.write_files(made.select("path", F.lit(bytearray(b"{}")).alias("content")), f"{base}/processed")
    read = spark.read.text(f"{base}/annotations", wholetext=True).select(F.col("value").alias("json"))
    markers = files.listed(spark, f"{base}/processed", "json").agg(F.count("*").alias("n"))
    return read.select("json", F.lit(None).cast("long").alias("n")).unionByName(markers.select(F.lit(None).cast("string").alias("json"), "n"))


ENVELOPE_SQL = """WITH t AS (SELECT l_orderkey, '{"items":[' || string_agg('{"n":' || l_linenumber || ',"part":' || l_partkey || '}', ',' ORDER BY l_linenumber, l_partkey) || ']}' AS j FROM lineitem WHERE l_orderkey <= 200 GROUP BY l_orderkey)
SELECT j AS json, NULL::BIGINT AS n FROM t UNION ALL SELECT NULL, count(*) FROM t"""


def error_maps(spark: SparkSession, d: str) -> DataFrame:
    """Decoding errors of three kinds added to each document's error map; a later one replaces an earlier of its key."""
    start = F.when(F.col("doc_id") % 4 == 0, F.create_map(F.lit("download"), F.lit("slow"), F.lit("motion"), F.lit("old")))
    message = F.when(F.col("doc_id") % 3 == 0, "no motion vectors").when(F.col("doc_id") % 5 == 0, "too small")
    made = text.with_error(start, "motion", message)
    return table(spark, d, "documents").select("doc_id", F.col("doc_id").isNotNull().alias("kept"), made["download"].alias("download"), made["motion"].alias("motion"), F.size(made).cast("long").alias("n"))


ERRORS_SQL = """WITH t AS (SELECT doc_id, doc_id % 4 = 0 AS old, CASE WHEN doc_id % 3 = 0 THEN 'no motion vectors' WHEN doc_id % 5 = 0 THEN 'too small' END AS e FROM documents)
SELECT doc_id, true AS kept, CASE WHEN old THEN 'slow' END AS download, coalesce(e, CASE WHEN old THEN 'old' END) AS motion, (old::INT + (old OR e IS NOT NULL)::INT)::BIGINT AS n FROM t"""


def input_checks(spark: SparkSession, d: str) -> DataFrame:
    """Whether each order's dates rise strictly and its prices are finite; a rule that all keep passes without an error."""
    made = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity"))), lambda x: x["l_quantity"]).alias("q"), F.collect_list(F.col("l_extendedprice").cast("double") / F.nullif(F.col("l_linenumber") - 5, F.lit(0))).alias("p"))
    records.assert_valid(made, some=F.size("q") > 0)
    return made.select("l_orderkey", records.rising(F.col("q")).alias("rises"), records.finite(F.col("p")).alias("finite"))


CHECKS_SQL = """WITH t AS (SELECT l_orderkey, l_quantity AS q, lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) AS before, l_linenumber FROM lineitem)
SELECT l_orderkey, bool_and(before IS NULL OR q > before) AS rises, true AS finite FROM t GROUP BY l_orderkey"""


def path_parts(spark: SparkSession, d: str) -> DataFrame:
    """Pages' addresses below a prefix, their folders, extensions, and lists with blanks split up."""
    url = F.col("url")
    return table(spark, d, "pages").select("page_id", text.relative_path(url, "https://site1.example").alias("relative"), text.parent_folder(url).alias("folder"), text.has_extension(url, "html", "htm").alias("is_page"), F.array_join(text.comma_list(F.concat(F.lit(" a,, "), F.col("page_id").cast("string"), F.lit(" ,b "))), "|").alias("list"), text.is_uuid(ids.uuid5(url)).alias("is_uuid"))


PATHS_SQL = """SELECT page_id, CASE WHEN starts_with(url, 'https://site1.example/') THEN substr(url, 23) ELSE url END AS relative, regexp_replace(url, '/[^/]*$', '') AS folder, regexp_matches(lower(url), '\\.(html|htm)$') AS is_page,
  'a|' || page_id || '|b' AS list, true AS is_uuid FROM pages"""


def caption_statuses(spark: SparkSession, d: str) -> DataFrame:
    """Outcomes of captions from a provider's finish reason and text."""
    reason = F.element_at(F.array(F.lit("stop"), F.lit("length"), F.lit("content_filter"), F.lit(None)), (F.col("turn") % 4 + 1).cast("int"))
    said = F.when(F.length("text") % 5 == 0, F.lit("  ")).when(F.length("text") % 7 != 0, F.col("text"))
    return table(spark, d, "conversations").select(text.caption_status(reason, said).alias("status")).groupBy("status").agg(F.count("*").alias("n_rows"))


STATUS_SQL = """SELECT CASE WHEN turn % 4 = 2 THEN 'blocked' WHEN length(text) % 5 = 0 OR length(text) % 7 = 0 THEN 'error' WHEN turn % 4 = 1 THEN 'truncated' ELSE 'success' END AS status, count(*) AS n_rows FROM conversations GROUP BY 1"""


def frame_picks(spark: SparkSession, d: str) -> DataFrame:
    """Of each document's frames (up to 60) every k-th from a common rate, and the middle one, the earlier of two."""
    n = F.least(F.col("n_chars"), F.lit(60))
    own = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<long>"))
    top = frames.lcm_rate([4, 6])
    return table(spark, d, "documents").select("doc_id", joined(spans.every_kth(own, top // 4)).alias("at_4"), joined(spans.every_kth(own, top // 6)).alias("at_6"), spans.middle_frame(own).alias("middle"))


PICKS_SQL = """SELECT doc_id, array_to_string(list_filter(range(n), lambda x: x % 3 = 0), ',') AS at_4, array_to_string(list_filter(range(n), lambda x: x % 2 = 0), ',') AS at_6, CASE WHEN n > 0 THEN (n - 1) // 2 END AS middle FROM (SELECT doc_id, least(n_chars, 60) AS n FROM documents) t"""


def scattered_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers that come back in another order put to their windows by key and index."""
    rows = table(spark, d, "conversations").select("conv_id", "turn")
    answers = table(spark, d, "conversations").orderBy(F.desc("text")).select("conv_id", "turn", F.upper("role").alias("answer")).dropDuplicates(["conv_id", "turn"])
    return frames.scattered(rows.distinct(), answers, ["conv_id", "turn"], "answer")


SCATTERED_SQL = "SELECT conv_id, turn, upper(role) AS answer FROM conversations"


def time_blobs(spark: SparkSession, d: str) -> DataFrame:
    """Each order's keys as a blob of 64-bit numbers and back, negative ones too, and the blob in base64."""
    arrays = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list((F.col("l_partkey") * F.when(F.col("l_linenumber") % 2 == 0, -1).otherwise(1_000_000_007)).cast("long"))).alias("v"))
    made = arrays.withColumn("b", blobs.blob(F.col("v")))
    return made.select("l_orderkey", joined(blobs.longs(F.col("b"))).alias("numbers"), F.octet_length("b").cast("long").alias("n_bytes"), F.base64(F.encode(F.col("l_orderkey").cast("string"), "utf-8")).alias("coded"))


BLOBS_SQL = "SELECT l_orderkey, array_to_string(list(x ORDER BY x), ',') AS numbers, count(*) * 8 AS n_bytes, base64(encode(l_orderkey::VARCHAR)) AS coded FROM (SELECT l_orderkey, l_partkey * CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1000000007 END AS x FROM lineitem) t GROUP BY l_orderkey"


def stream_arrivals(spark: SparkSession, d: str) -> DataFrame:
    """Orders as arriving files, appended to a table by key: each once, though the stream is run twice."""
    base = shared_folder(spark, "arrivals")
    schema = table(spark, d, "orders").schema
    for _ in range(2):
        stream = arrivals.arriving(spark, f"{d}/orders.parquet*", schema)
        arrivals.process(stream, f"{base}/state-{_}", lambda b: b.select("o_orderkey", "o_orderstatus"), f"{base}/rows", "o_orderkey").awaitTermination()
    return spark.read.parquet(f"{base}/rows")


def jdbc_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Customers appended to a database table under two run ids, one of them twice, and queried back."""
    base = shared_folder(spark, "jdbc").removeprefix("file:")
    url = f"jdbc:derby:;databaseName={base};create=true"
    rows = table(spark, d, "nation").select("n_nationkey", "n_name")
    rows.limit(0).withColumn("run_uuid", F.lit("")).write.format("jdbc").option("url", url).option("dbtable", "runs").option("createTableColumnTypes", "run_uuid VARCHAR(64), n_name VARCHAR(64)").mode("append").save()
    for run in ("one", "two", "one"):
        records.append_run(rows, url, "runs", run, limit="FETCH FIRST 1 ROWS ONLY")
    return files.jdbc_query(spark, url, 'SELECT "run_uuid", "n_nationkey", "n_name" FROM runs WHERE "n_nationkey" < 20')


JDBC_SQL = "SELECT run_uuid, n_nationkey, n_name FROM nation, (VALUES ('one'), ('two')) v(run_uuid) WHERE n_nationkey < 20"


def _videos(key, n):
    samples = [(bytes([i % 251]) * (key % 7 + 1), (i ^ 1) if (i ^ 1) < n else i, i, i % 12 == 0) for i in range(n)]
    return (packets.muxed(samples, 30, 640 + key % 5, 480) if key % 9 else b"no video",)


def packet_index(spark: SparkSession, d: str) -> DataFrame:
    """Packets in presentation order, metadata and errors of a video for each order, written in decode order."""
    from skein.operators import kernels

    rows = table(spark, d, "orders").select(F.col("o_orderkey").cast("long").alias("o_orderkey"), (F.col("o_orderkey") % 40 + 2).cast("long").alias("n"))
    made = packets.indexed(kernels.with_kernel(rows, kernels.Rowwise("content binary", _videos, "o_orderkey", "n")).drop("kernel_error"))
    ordered = F.forall(F.zip_with(F.slice("packets", F.lit(1), F.greatest(F.size("packets") - 1, F.lit(0))), F.slice("packets", F.lit(2), F.greatest(F.size("packets") - 1, F.lit(0))), lambda a, b: a["pts"] < b["pts"]), lambda x: x)
    keys = F.size(F.filter("packets", lambda p: p["is_key"]))
    return made.select("o_orderkey", F.col("metadata.width").alias("width"), F.col("metadata.num_frames").alias("frames"), keys.cast("long").alias("n_keys"), ordered.alias("ordered"), F.element_at("packets", -1)["pts_ns"].alias("last_ns"), F.aggregate("packets", F.lit(0).cast("long"), lambda a, p: a + p["size"]).alias("bytes"), (F.size("errors") > 0).alias("failed"))


PACKET_SQL = """WITH t AS (SELECT o_orderkey::BIGINT AS k, o_orderkey % 40 + 2 AS n, o_orderkey % 9 > 0 AS ok FROM orders)
SELECT k AS o_orderkey, CASE WHEN ok THEN (640 + k % 5)::INT END AS width, CASE WHEN ok THEN n END::BIGINT AS frames, CASE WHEN ok THEN (n - 1) // 12 + 1 END::BIGINT AS n_keys, CASE WHEN ok THEN true END AS ordered,
  CASE WHEN ok THEN (n - 1) * 1000000000 // 30 END::BIGINT AS last_ns, CASE WHEN ok THEN n * (k % 7 + 1) END::BIGINT AS bytes, NOT ok AS failed FROM t"""


def _zipped(names):
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n in [*names, "../outside"]:
            z.writestr(n, n[:1])
    return (out.getvalue(),)


def collected_inputs(spark: SparkSession, d: str) -> DataFrame:
    """A zip of nations for each region unpacked below a folder and collected in another: names and sizes there."""
    from skein.operators import kernels

    base = shared_folder(spark, "zips")
    names = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.concat_ws("/", F.col("n_regionkey").cast("string"), F.concat(F.replace("n_name", F.lit(" "), F.lit("_")), F.lit(".mp4"))))).alias("names"))
    zips = kernels.with_kernel(names, kernels.Rowwise("content binary", _zipped, "names"))
    sinks.write_files(files.unpacked(zips), f"{base}/in")
    sinks.collected(files.listed(spark, f"{base}/in"), f"{base}/all")
    return files.listed(spark, f"{base}/all").select("relative", "length")


COLLECTED_SQL = "SELECT n_regionkey || '/' || replace(n_name, ' ', '_') || '.mp4' AS relative, 1::BIGINT AS length FROM nation"


def _pictures(key):
    import numpy as np

    return (images.to_png(np.full((key % 4 + 1, key % 6 + 1, 3), key % 256, np.uint8)) if key % 5 else b"words",)


def image_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Formats and sizes of an image for each part, and the errors of what is none."""
    from skein.operators import kernels

    rows = table(spark, d, "part").select(F.col("p_partkey").cast("long").alias("p_partkey"))
    made = images.loaded(kernels.with_kernel(rows, kernels.Rowwise("content binary", _pictures, "p_partkey")).drop("kernel_error"))
    return made.select("p_partkey", "format", "width", "height", (F.size("errors") > 0).alias("failed"))


IMAGES_SQL = "SELECT p_partkey::BIGINT AS p_partkey, CASE WHEN ok THEN 'png' END AS format, CASE WHEN ok THEN (p_partkey % 6 + 1)::INT END AS width, CASE WHEN ok THEN (p_partkey % 4 + 1)::INT END AS height, NOT ok AS failed FROM (SELECT *, p_partkey % 5 > 0 AS ok FROM part) t"


def shard_packages(spark: SparkSession, d: str) -> DataFrame:
    """Documents as clips in three archives a source, members counted and videos added up."""
    docs = table(spark, d, "documents").select("doc_id", "source", F.encode("text", "utf-8").alias("video"), F.to_json(F.struct("lang", "n_chars")).alias("j"), F.array(F.array(F.lit(0.5))).alias("e"))
    made = packages.shard_members(docs, "doc_id", F.concat("source", F.lit("/000000.tar")), "video", F.col("j"), "e")
    return made.groupBy("path").agg(F.count("*").alias("n_keys"), F.sum(F.when(F.endswith("name", F.lit(".pickle")), 0).otherwise(F.octet_length("data"))).alias("n_bytes"))


SHARDS_SQL = """SELECT k || '/' || source || '/000000.tar' AS path, count(*) AS n_keys, sum(CASE k WHEN 'video' THEN strlen(text) WHEN 'metas' THEN strlen('{"lang":"' || lang || '","n_chars":' || n_chars || '}') ELSE 0 END)::BIGINT AS n_bytes
FROM documents, (VALUES ('video'), ('metas'), ('t5_xxl')) v(k) GROUP BY k, source"""


def session_archives(spark: SparkSession, d: str) -> DataFrame:
    """Orders with line items 1 and 2 as sessions of two cameras: names and sizes in one archive each, and their caption archives."""
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("s"), F.col("l_linenumber").cast("int").alias("camera"), F.encode(F.col("l_partkey").cast("string"), "utf-8").alias("video"), F.array(F.col("l_suppkey").cast("long"), F.col("l_partkey").cast("long")).alias("ms"))
    whole = packages.whole_sessions(items, "s", "camera", {1: "front", 2: "rear"})
    made = packages.session_members(whole, "s", "raw", "video", "ms").select("path", "name", F.octet_length("data").cast("long").alias("n_bytes"))
    rich = whole.withColumn("clip", F.concat_ws("-", "s", "camera")).withColumn("emb", F.array(F.array(F.lit(1.0)))).withColumn("cap", F.array("camera_name")).withColumn("w", F.array(F.lit(0)))
    texts = packages.caption_members(rich, "s", "clip", ["default"], "emb", "cap", "w", "w").filter(F.endswith("name", F.lit(".json")))
    return made.unionByName(texts.select("path", "name", F.octet_length("data").cast("long").alias("n_bytes")))


SESSIONS_SQL = """WITH w AS (SELECT l_orderkey AS s, CASE l_linenumber WHEN 1 THEN 'front' ELSE 'rear' END AS c, l_linenumber AS n, l_partkey AS p, l_suppkey AS m FROM lineitem WHERE l_linenumber IN (1, 2)
  AND l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber IN (1, 2) GROUP BY 1 HAVING count(DISTINCT l_linenumber) = 2))
SELECT 'raw/' || s || '.tar' AS path, s || '.' || c || '.mp4' AS name, length(p::VARCHAR) AS n_bytes FROM w
UNION ALL SELECT 'raw/' || s || '.tar', s || '.' || c || '.json', length('[{"frame_num":0,"timestamp":' || m || '},{"frame_num":1,"timestamp":' || p || '}]') FROM w
UNION ALL SELECT 'default/' || s || '.tar', s || '.' || c || '.json', length('["' || s || '-' || n || '", ["' || c || '"], [0], [0]]') FROM w"""


def clip_files(spark: SparkSession, d: str) -> DataFrame:
    """All files of documents as clips of two cameras, kept or rejected, and the markers of their videos, by digest."""
    docs = table(spark, d, "documents").select("doc_id", "source", (F.col("doc_id") % 2).alias("rank"), F.when(F.col("n_chars") < 500, "motion").alias("stage_rejected"), F.encode("text", "utf-8").alias("video"), F.transform(F.sequence(F.lit(1), F.least(F.lit(3), F.col("n_chars")).cast("int")), lambda i: F.encode(i.cast("string"), "utf-8")).alias("previews"), F.array(F.lit(0.5)).alias("e"), "n_chars")
    made = packages.clip_files(docs, "doc_id", "source", "rank", "video", "previews", "e", F.to_json(F.struct("doc_id", "n_chars")), "vectors")
    chunks = table(spark, d, "lineitem").filter("l_linenumber <= 2").select(F.concat(F.lit("v"), F.col("l_orderkey").cast("string")).alias("v"), (F.col("l_linenumber") - 1).alias("c")).groupBy("v", "c").agg(F.lit(2).alias("n"))
    marks = packages.marker_files(chunks, "v", "c", "n", F.to_json(F.struct("v", "c")))
    return made.unionByName(marks).select("path", F.when(F.endswith("path", F.lit(".pickle")), F.lit(None)).otherwise(F.md5("content")).alias("digest"))


CLIP_FILES_SQL = """WITH t AS (SELECT doc_id, source, n_chars, text, n_chars >= 500 AS kept, doc_id % 2 = 0 AS main FROM documents)
SELECT CASE WHEN kept THEN 'clips/' ELSE 'filtered_clips/' END || source || '/' || doc_id || '.mp4' AS path, md5(text) AS digest FROM t
UNION ALL SELECT 'metas/v0/' || doc_id || '.json', md5('{"doc_id":' || doc_id || ',"n_chars":' || n_chars || '}') FROM t WHERE main
UNION ALL SELECT 'vectors/' || doc_id || '.pickle', NULL FROM t WHERE main AND kept
UNION ALL SELECT 'previews/' || doc_id || '_' || i || '.webp', md5((i + 1)::VARCHAR) FROM t, range(3) r(i) WHERE main AND kept
UNION ALL SELECT DISTINCT 'processed_clip_chunks/v' || l_orderkey || '_' || (l_linenumber - 1) || '.json', md5('{"v":"v' || l_orderkey || '","c":' || (l_linenumber - 1) || '}') FROM lineitem WHERE l_linenumber <= 2
UNION ALL SELECT DISTINCT 'processed_videos/v' || l_orderkey || '.json', md5('{"num_clip_chunks":2}') FROM lineitem WHERE l_linenumber = 1"""


def dataset_files(spark: SparkSession, d: str) -> DataFrame:
    """Documents as a dataset of single files by source, those without a video keeping the rest."""
    docs = table(spark, d, "documents").select("doc_id", "source", F.when(F.col("doc_id") % 4 > 0, F.encode("text", "utf-8")).alias("video"), "lang", F.array(F.lit(0.5)).alias("e"))
    made = packages.exported(docs, "set", "doc_id", "source", "video", "lang", "e")
    return made.select("path", F.when(F.endswith("path", F.lit(".pickle")), F.lit(None)).otherwise(F.md5("content")).alias("digest"))


DATASET_SQL = """SELECT 'set/videos/' || source || '/' || doc_id || '.mp4' AS path, md5(text) AS digest FROM documents WHERE doc_id % 4 > 0
UNION ALL SELECT 'set/metas/' || source || '/' || doc_id || '.txt', md5(lang) FROM documents UNION ALL SELECT 'set/t5_xxl/' || source || '/' || doc_id || '.pickle', NULL FROM documents"""

QUERIES = {
    f.__name__: f
    for f in (
        file_listing, session_files, retried_reads, input_lists, clip_metadata_rows, embedding_files, saved_tasks, sqlite_rows, mcap_messages, session_stamps, archive_round_trip, sink_formats, routed_clips, committed_fragments,
        vector_store_rows, annotation_envelopes, error_maps, input_checks, path_parts, caption_statuses, frame_picks, scattered_answers, time_blobs, stream_arrivals, jdbc_catalog, packet_index, image_sizes, collected_inputs, shard_packages, session_archives, clip_files, dataset_files,
    )
}
ORACLES = {
    "file_listing": LISTING_SQL,
    "session_files": SESSION_SQL,
    "retried_reads": READS_SQL,
    "input_lists": LISTS_SQL,
    "clip_metadata_rows": METADATA_SQL,
    "embedding_files": EMBEDDING_SQL,
    "saved_tasks": SAVED_SQL,
    "sqlite_rows": "SELECT n_name AS name, n_nationkey::BIGINT AS nation FROM nation",
    "mcap_messages": MCAP_SQL,
    "session_stamps": STAMPS_SQL,
    "archive_round_trip": ARCHIVE_SQL,
    "sink_formats": FORMATS_SQL,
    "routed_clips": ROUTED_SQL,
    "committed_fragments": FRAGMENTS_SQL,
    "vector_store_rows": VECTOR_SQL,
    "annotation_envelopes": ENVELOPE_SQL,
    "error_maps": ERRORS_SQL,
    "input_checks": CHECKS_SQL,
    "path_parts": PATHS_SQL,
    "caption_statuses": STATUS_SQL,
    "frame_picks": PICKS_SQL,
    "scattered_answers": SCATTERED_SQL,
    "time_blobs": BLOBS_SQL,
    "stream_arrivals": "SELECT o_orderkey, o_orderstatus FROM orders",
    "jdbc_catalog": JDBC_SQL,
    "packet_index": PACKET_SQL,
    "image_sizes": IMAGES_SQL,
    "collected_inputs": COLLECTED_SQL,
    "shard_packages": SHARDS_SQL,
    "session_archives": SESSIONS_SQL,
    "clip_files": CLIP_FILES_SQL,
    "dataset_files": DATASET_SQL,
}
