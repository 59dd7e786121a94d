import io
import json
import sqlite3
import struct
import subprocess
import sys
import tarfile
import zipfile

import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from skein.operators import records
from skein.sources import files, mcap, sinks, sqlite
from skein.streaming import arrivals

U = "123e4567-e89b-12d3-a456-426614174000"


@pytest.fixture
def tree(tmp_path):
    for p in (f"{U}/front.mp4", f"{U}/left.mp4", "other/a.MP4", "other/b.jpg", "c.txt"):
        (tmp_path / p).parent.mkdir(exist_ok=True)
        (tmp_path / p).write_bytes(b"x" * 3)
    return str(tmp_path)


def test_listing(spark, tree):
    got = files.listed(spark, tree, *files.VIDEO)
    assert sorted(r.relative for r in got.collect()) == [f"{U}/front.mp4", f"{U}/left.mp4", "other/a.MP4"]
    everything = files.listed(spark, tree)
    assert sorted(r.folder for r in files.top_folders(everything).collect()) == [U, "other"]
    assert {r.session for r in files.sessions(everything).collect()} == {U}
    assert sorted(r.n_files for r in files.parent_counts(everything).collect()) == [1, 2, 2]


def test_lists(spark, tmp_path):
    p = tmp_path / "in.json"
    p.write_text(json.dumps(["s3://b/in/a.mp4", "s3://b/in/x/b.mp4"]))
    assert [r.relative for r in files.input_list(spark, str(p), "s3://b/in").collect()] == ["a.mp4", "x/b.mp4"]
    with pytest.raises(Exception, match="not below"):
        files.input_list(spark, str(p), "s3://b/in/x").collect()
    (tmp_path / "s.txt").write_text("/d/s1/a.mp4\n/d/s1/b.mp4\nnoise\n/d/s2/c.h264\n")
    assert sorted(r.session for r in files.session_file(spark, str(tmp_path / "s.txt")).collect()) == ["/d/s1", "/d/s2"]


def test_clip_metadata(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"span_uuid": "u", "valid": True, "windows": [{"start": "0"}]}))
    (tmp_path / "b.json").write_text(json.dumps({"span_uuid": "v", "valid": False}))
    rows = files.clip_metadata(spark, str(tmp_path)).collect()
    assert [r.span_uuid for r in rows] == ["u"] and rows[0].aesthetic_score is None


def test_archives_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("x/000000.tar", "k1.mp4", b"1"), ("x/000000.tar", "k1.json", b"{}"), ("y/000000.tar", "k2.mp4", b"22")], "p string, n string, d binary")
    made = sinks.archives(df, "p", "n", "d")
    assert {r.path: r.n_keys for r in made.collect()} == {"x/000000.tar": 2, "y/000000.tar": 1}
    sinks.write_files(made, str(tmp_path))
    sinks.write_files(made, str(tmp_path))
    got = {r.key: {k: bytes(v) for k, v in r.data.items()} for r in files.archive_samples(spark, str(tmp_path)).collect()}
    assert got == {"k1": {"mp4": b"1", "json": b"{}"}, "k2": {"mp4": b"22"}}


def test_archive_errors_and_zip(spark, tmp_path):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("d/a.txt", "t")
    (tmp_path / "a.zip").write_bytes(out.getvalue())
    assert [(r.key, dict(r.data)) for r in files.archive_samples(spark, str(tmp_path), "zip").collect()] == [("d/a", {"txt": bytearray(b"t")})]
    with tarfile.open(tmp_path / "b.tar", "w") as t:
        for _ in range(2):
            info = tarfile.TarInfo("a.txt")
            t.addfile(info, io.BytesIO(b""))
    with pytest.raises(Exception, match="suffix occurs twice"):
        files.archive_samples(spark, str(tmp_path)).collect()


def test_existing_destinations(spark, tmp_path):
    path, one, two = str(tmp_path / "t"), spark.range(1), spark.range(2)
    for kind in ("parquet", "json", "csv"):
        p = f"{path}-{kind}"
        sinks.write(one, p, kind)
        sinks.write(two, p, kind)
        assert spark.read.option("header", "true").format(kind).load(p).count() == 1
        sinks.write(two, p, kind, sinks.BACKUP)
        sinks.write(one, p, kind, sinks.BACKUP)
        assert (tmp_path / f"t-{kind}.bak-0").exists() and (tmp_path / f"t-{kind}.bak-1").exists()
        sinks.write(two, p, kind, sinks.OVERWRITE, one_file=True)
        assert spark.read.option("header", "true").format(kind).load(p).count() == 2


def test_routed_and_appended(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "motion")], "k int, stage_rejected string")
    sinks.routed(df, str(tmp_path / "r"))
    assert (tmp_path / "r/route=clips").exists() and (tmp_path / "r/route=filtered_clips").exists()
    for _ in range(2):
        sinks.append_new(df, str(tmp_path / "a"), "k")
    assert spark.read.parquet(str(tmp_path / "a")).count() == 2
    v = sinks.vector_rows(spark.createDataFrame([("u", [1.0], ["a", "b"])], "id string, e array<float>, c array<string>"), "id", "e", "c").first()
    assert json.loads(v["$meta"]) == {"caption": "a | b"}


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "t.db")
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE t (a INTEGER, b TEXT)")
        con.executemany("INSERT INTO t VALUES (?, ?)", [(i, f"x{i}") for i in range(100)])
        con.execute("CREATE TABLE e (a INTEGER)")
    sqlite.register(spark)
    df = spark.read.format("skein_sqlite").schema("b string, a int").option("path", path).option("table", "t").option("partitions", "4").load()
    assert df.count() == 100 and df.agg(F.sum("a")).first()[0] == 4950 and df.filter("a = 7").first().b == "x7"
    assert spark.read.format("skein_sqlite").schema("a int").option("path", path).option("table", "e").load().count() == 0


def test_arrivals(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = spark.range(1).schema
    for lo in (0, 5):
        spark.range(lo, lo + 10).coalesce(1).write.mode("append").parquet(src)
        arrivals.process(arrivals.arriving(spark, src, schema), state, lambda b: b.filter("id % 2 = 0"), out, "id").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(0, 15, 2))


def test_first_arrivals(spark, tmp_path):
    df = spark.createDataFrame([(1, 0), (1, 60), (2, 30)], "k int, s long").select("k", F.timestamp_seconds("s").alias("t"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = arrivals.first_arrivals(arrivals.arriving(spark, str(tmp_path / "in"), df.schema), "k", "t", "1 hour")
    q = stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def record(op, body):
    return struct.pack("<BQ", op, len(body)) + body


def text_of(t):
    return struct.pack("<I", len(t)) + t.encode()


def message(channel, seq, log, data):
    return record(mcap.MESSAGE, struct.pack("<HIQQ", channel, seq, log, log) + data)


def test_mcap(spark, tmp_path):
    inner = record(mcap.CHANNEL, struct.pack("<HH", 1, 0) + text_of("/cam") + text_of("raw") + struct.pack("<I", 0)) + message(1, 2, 200, b"b") + message(1, 1, 100, b"a") + message(2, 9, 150, b"x")
    head = struct.pack("<QQQI", 100, 200, len(inner), 0)
    packed = zstandard.ZstdCompressor().compress(inner)
    late = message(1, 3, 300, b"c")
    body = record(mcap.CHUNK, head + text_of("zstd") + struct.pack("<Q", len(packed)) + packed) + record(mcap.CHUNK, struct.pack("<QQQI", 300, 300, len(late), 0) + text_of("") + struct.pack("<Q", len(late)) + late) + message(1, 4, 400, b"d")
    (tmp_path / "a.mcap").write_bytes(mcap.MAGIC + body)
    get = lambda *a: [(r.log_time_ns, r.sequence, bytes(r.data)) for r in mcap.scanned(spark, str(tmp_path), "/cam", *a).collect()]
    assert get() == [(100, 1, b"a"), (200, 2, b"b"), (300, 3, b"c"), (400, 4, b"d")]
    assert get(200, 400) == [(200, 2, b"b"), (300, 3, b"c")]
    assert get(300, 301) == [(300, 3, b"c")]
    (tmp_path / "b.mcap").write_bytes(b"no")
    with pytest.raises(Exception, match="no MCAP"):
        get()


def test_session_timestamps(spark):
    lines = spark.createDataFrame([("2, 100",), ("bad",), ("7,5",), (None,)], "value string")
    assert sorted(tuple(r) for r in mcap.session_timestamps(lines).collect()) == [(2, 100), (7, 5)]
    assert [tuple(r) for r in mcap.session_timestamps(lines, {2: 20}).collect()] == [(20, 100)]


CLUSTER = """
import sys
from pyspark.sql import SparkSession
from skein.plans import catalogue
from skein.session import ship
conf = {"spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.executor.memory": "512m", "spark.checkpoint.dir": f"file://{sys.argv[1]}/shared"}
spark = SparkSession.builder.master("local-cluster[2,1,600]").config(map=conf).getOrCreate()
ship(spark)
print(catalogue.QUERIES["jdbc_catalog"](spark, sys.argv[2]).distinct().count())
spark.stop()
"""


def test_jdbc_catalog_where_executors_are_other_processes(sf, tmp_path):
    said = subprocess.run([sys.executable, "-c", CLUSTER, str(tmp_path), sf], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert said.returncode == 0, said.stderr[-3000:]
    assert said.stdout.split()[-1] == "40"


def test_database_files_take_all_kinds_of_values(spark, tmp_path):
    url = f"jdbc:derby:;databaseName={tmp_path}/d;create=true"
    rows = spark.createDataFrame([(1, 2.5, True, "it's", bytearray(b"\0\1"), "2024-02-29"), (None,) * 6], "i int, x double, b boolean, s string, c binary, d string").withColumn("d", F.to_date("d"))
    rows.limit(0).withColumn("run_uuid", F.lit("")).write.format("jdbc").option("url", url).option("dbtable", "t").option("createTableColumnTypes", "run_uuid VARCHAR(64)").mode("append").save()
    for _ in range(2):
        records.append_run(rows, url, "t", "o'ne", limit="FETCH FIRST 1 ROWS ONLY")
        got = files.jdbc_query(spark, url, 'SELECT "i", "x", "b", "s", "c", "d" FROM t')
        assert sorted(map(repr, got.collect())) == sorted(map(repr, rows.collect()))


def test_archives_of_bounded_bytes(spark):
    """No archive goes on after the limit, keys stay whole, whatever suffixes and dots they have, and nothing is lost."""
    rows = [("en/web.tar", f"{k}{e}", bytes([i % 251]) * 3000) for i in range(120) for k in (f"k{i}", f"k{i}.more") for e in (".a", ".txt")] + [("plain", "one", b"1")]
    df = spark.createDataFrame(rows, "p string, n string, d binary").repartition(3)
    made = sinks.archives(df, "p", "n", "d", 50_000).collect()
    seen, found = {}, []
    for r in made:
        assert len(r.content) < 50_000 + 2 * 4096 + 10_240
        for n, c in files.members("tar", bytes(r.content)):
            found.append((n, c))
            assert seen.setdefault(n.rpartition(".")[0] or n, r.path) == r.path
    assert sorted(found) == sorted((n, c) for _, n, c in rows) and len({r.path for r in made}) == len(made) > 20
    assert sum(r.n_keys for r in made) == len(rows) and {r.path.split("-")[0] for r in made} == {"en/web", "plain"}


def test_members_of_a_large_archive_go_on_in_parts(spark, tmp_path):
    with tarfile.open(tmp_path / "a.tar", "w") as t:
        for i in range(9):
            info = tarfile.TarInfo(f"{i}.txt")
            info.size = 400_000
            t.addfile(info, io.BytesIO(bytes(400_000)))
    data = pa.py_buffer((tmp_path / "a.tar").read_bytes())
    assert [b.num_rows for b in files._parts(files.members("tar", data), ["name", "content"])] == [3, 3, 3]
    assert files.archive_samples(spark, str(tmp_path)).count() == 9
