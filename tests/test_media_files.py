"""Packet indexes, images, packages and fragments, against files made here."""

import io
import json
import pickle
import struct
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.operators import shots
from skein.sources import fragments, images, packages, packets, sinks


def h264(pictures):
    """A raw stream: parameter sets before each key picture, two slices a picture."""
    out = []
    for i, key in enumerate(pictures):
        if key:
            out += [b"\0\0\0\1" + bytes([0x67, 1, 2, 3]), b"\0\0\1" + bytes([0x68, 9])]
        kind = 0x65 if key else 0x41
        out += [b"\0\0\1" + bytes([kind, 0x80 | i % 64, 5, 6, i % 200 + 1]), b"\0\0\1" + bytes([kind, 0x40, 7, 8])]
    return b"".join(out)


def test_index_of_reordered_pictures_against_what_was_muxed(spark, tmp_path):
    pts = [0, 3, 1, 2, 6, 4, 5, 9]
    samples = [(bytes([i]) * (i + 5), p + 1, i, i in (0, 4)) for i, p in enumerate(pts)]
    data = packets.muxed(samples, 30, 640, 480)
    t = packets.mp4_track(data)
    assert [(p.pts, p.dts, p.is_key) for p in t.packets] == [(s[1], s[2], s[3]) for s in samples]
    assert [data[p.offset : p.offset + p.size] for p in t.packets] == [s[0] for s in samples]
    assert (t.width, t.height, t.timescale, t.codec) == (640, 480, 30, "h264")
    (tmp_path / "a.mp4").write_bytes(data)
    (tmp_path / "cut.mp4").write_bytes(data[:-20])
    (tmp_path / "no.mp4").write_bytes(b"words")
    (tmp_path / "keyless.mp4").write_bytes(packets.muxed([(b"x", 0, 0, False)], 30))
    files = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content")
    rows = {r.path.rsplit("/", 1)[1]: r for r in packets.indexed(files).collect()}
    assert len(rows) == 4
    a = rows["a.mp4"]
    assert [p.pts for p in a.packets] == sorted(p + 1 for p in pts) and a.errors == {}
    assert [p.pts_ns for p in a.packets] == [(p + 1) * 10**9 // 30 for p in sorted(pts)]
    assert a.metadata.num_frames == 8 and a.metadata.bit_rate_bps == int(sum(len(s[0]) for s in samples) * 8 / ((10 * 10**9 // 30 - 10**9 // 30) / 1e9))
    assert all(rows[n].metadata is None and set(rows[n].errors) == {"probe"} for n in ("cut.mp4", "no.mp4", "keyless.mp4"))


def test_demuxed_stream_and_its_container_agree():
    pictures = [i % 7 == 0 for i in range(30)]
    raw = h264(pictures)
    direct, wrapped = packets.track(raw), packets.track(packets.wrapped(raw, 30))
    assert [p.is_key for p in direct.packets] == pictures == [p.is_key for p in wrapped.packets]
    assert [p.pts for p in direct.packets] == [p.pts for p in wrapped.packets] == list(range(30))
    data = packets.wrapped(raw, 30)
    for a, b in zip(direct.packets, wrapped.packets):
        units, at, body = [], 0, data[b.offset : b.offset + b.size]
        while at < len(body):
            (n,) = struct.unpack_from(">I", body, at)
            units.append(body[at + 4 : at + 4 + n])
            at += 4 + n
        own = b"\0\0\1" + raw[a.offset : a.offset + a.size]
        assert units == [own[x:y] for x, y in packets.nal_units(own)]
    with pytest.raises(ValueError):
        packets.h264_track(b"\0\0\1\x67")


def test_images(spark, tmp_path):
    rng = np.random.default_rng(1)
    pixels = rng.integers(0, 256, (5, 7, 3), dtype=np.uint8)
    png = images.to_png(pixels)
    assert (images.png_pixels(png) == pixels).all() and images.described(png) == ("png", 7, 5)
    made = {
        "a.png": (png, ("png", 7, 5)),
        "b.gif": (b"GIF89a" + struct.pack("<HH", 320, 200) + b"...", ("gif", 320, 200)),
        "c.bmp": (b"BM" + bytes(16) + struct.pack("<ii", 9, -4), ("bmp", 9, 4)),
        "d.jpg": (b"\xff\xd8\xff\xe0" + struct.pack(">H", 4) + b"xx\xff\xc0" + struct.pack(">HBHH", 11, 8, 33, 44) + bytes(8), ("jpeg", 44, 33)),
        "e.webp": (b"RIFF\0\0\0\0WEBPVP8X" + bytes(8) + (99).to_bytes(3, "little") + (49).to_bytes(3, "little"), ("webp", 100, 50)),
        "f.jpg": (b"\xff\xd8\xff", None),
        "g.txt": (b"words", None),
    }
    for name, (data, _) in made.items():
        (tmp_path / name).write_bytes(data)
    files = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content")
    for r in images.loaded(files).collect():
        want = made[r.path.rsplit("/", 1)[1]][1]
        assert ((r.format, r.width, r.height) == want and r.errors == {}) if want else (r.format is None and set(r.errors) == {"load"})


@pytest.mark.parametrize("kind", [1, 2, 3, 4])
def test_png_filters_against_definition(kind):
    rng = np.random.default_rng(kind)
    want = rng.integers(0, 256, (2, 12))
    paeth = lambda a, b, c: min((a, b, c), key=lambda x: abs(a + b - c - x))
    above, line = want
    left = lambda i: int(line[i - 3]) if i >= 3 else 0
    corner = lambda i: int(above[i - 3]) if i >= 3 else 0
    guess = {1: left, 2: lambda i: int(above[i]), 3: lambda i: (left(i) + int(above[i])) // 2, 4: lambda i: paeth(left(i), int(above[i]), corner(i))}[kind]
    coded = np.array([(int(line[i]) - guess(i)) % 256 for i in range(12)])
    assert images._unfiltered(kind, coded, above, 3).tolist() == line.tolist()


def reference_windows(n):
    """Windows of 100 frames at a hop of 50 from 25 before the first on, the first one filled up with frame 0."""
    out = []
    for i in range(0, n + -n % 50, 50):
        own = list(range(n))[max(i - 25, 0) : i + 75]
        out.append([0] * max(0, 25 - i) + own)
    return out


@pytest.mark.parametrize("n", [0, 1, 24, 25, 49, 50, 51, 74, 75, 76, 100, 149, 150, 151, 333])
def test_shot_windows(spark, n):
    frames = F.sequence(F.lit(0), F.lit(n - 1)) if n else F.array().cast("array<int>")
    r = spark.range(1).select(shots.batches(frames).alias("b"), shots.middles(shots.batches(frames), F.lit(n)).alias("m")).first()
    assert r.b == reference_windows(n) and r.m == list(range(n))


def members(content):
    with tarfile.open(fileobj=io.BytesIO(content)) as t:
        return {m.name: t.extractfile(m).read() for m in t.getmembers()}


def test_shards_are_three_archives(spark):
    rows = [(f"c{i}", i // 2, bytes([i]), i * 10, [[float(i)], [0.5]]) for i in range(5)]
    df = spark.createDataFrame(rows, "uuid string, g int, video binary, frames int, emb array<array<double>>")
    made = packages.shard_members(df, "uuid", F.format_string("bin/%06d.tar", "g"), "video", F.to_json(F.struct("frames")), "emb")
    got = {r.path: members(r.content) for r in sinks.archives(made, "path", "name", "data").collect()}
    assert sorted(got) == sorted(f"{k}/bin/{g:06d}.tar" for k in packages.SHARD_KINDS for g in range(3))
    assert got["video/bin/000001.tar"] == {"c2.mp4": b"\2", "c3.mp4": b"\3"} and json.loads(got["metas/bin/000002.tar"]["c4.json"]) == {"frames": 40}
    assert pickle.loads(got["t5_xxl/bin/000000.tar"]["c1.pickle"]) == [[1.0], [0.5]]
    with pytest.raises(Exception, match="no video of clip"):
        packages.shard_members(df.withColumn("video", F.lit(None).cast("binary")), "uuid", F.lit("x"), "video", F.lit("{}"), "emb").collect()


def test_session_packages(spark):
    cams = {1: "front", 2: "rear"}
    rows = [("s1", 1, b"a", [10, 20]), ("s1", 2, b"b", [11]), ("s1", 9, b"z", [0]), ("s2", 1, b"c", [5])]
    df = spark.createDataFrame(rows, "session string, camera int, video binary, ms array<long>").withColumn("emb", F.array(F.array(F.lit(1.5)), F.array(F.lit(2.5)))).withColumn("clip", F.concat("session", F.col("camera").cast("string"))).withColumn("cap", F.array(F.lit('say "x"'), F.lit("y"))).withColumn("w", F.array(F.lit(0), F.lit(8)))
    whole = packages.whole_sessions(df, "session", "camera", cams)
    got = {r.path: members(r.content) for r in sinks.archives(packages.session_members(whole, "session", "raw", "video", "ms", None), "path", "name", "data").collect()}
    assert list(got) == ["raw/s1.tar"] and sorted(got["raw/s1.tar"]) == ["s1.front.json", "s1.front.mp4", "s1.rear.json", "s1.rear.mp4"]
    assert json.loads(got["raw/s1.tar"]["s1.front.json"]) == [{"frame_num": 0, "timestamp": 10}, {"frame_num": 1, "timestamp": 20}]
    by = {r.path: members(r.content) for r in sinks.archives(packages.caption_members(whole, "session", "clip", ["v0", "v1"], "emb", "cap", "w", "w"), "path", "name", "data").collect()}
    assert sorted(by) == ["v0/s1.tar", "v1/s1.tar"] and pickle.loads(by["v1/s1.tar"]["s1.rear.bin"]) == [2.5]
    assert json.loads(by["v0/s1.tar"]["s1.front.json"]) == ["s11", ['say "x"'], [0], [0]]
    many = spark.range(40).select(F.lit(7).alias("part"), F.format_string("s%03d", "id").alias("session"), F.lit("front").alias("camera_name"), F.array(F.array(F.lit(1.0)), F.array(F.lit(2.0))).alias("emb"))
    sizes = {r.path: r.n_keys for r in sinks.archives(packages.numbered_members(many, "part", "session", ["v0", "v1"], "emb"), "path", "name", "data").collect()}
    assert sizes == {f"{v}/part_000007/t5_{k:06d}.tar": n for v in ("v0", "v1") for k, n in enumerate((16, 16, 8))}


def test_dataset_export(spark, tmp_path):
    df = spark.createDataFrame([("c1", "front", b"v", "a caption", [0.5]), ("c2", "front", None, "b", [1.0])], "clip string, view string, video binary, cap string, emb array<double>")
    sinks.write_files(packages.exported(df, "set", "clip", "view", "video", "cap", "emb"), str(tmp_path))
    sinks.write_files(packages.prefix_cache(df.limit(1), "set", "view", "emb"), str(tmp_path))
    assert sorted(p.relative_to(tmp_path).as_posix() for p in tmp_path.rglob("*.*")) == ["set/cache/prefix_t5_embeddings_front.pickle", "set/metas/front/c1.txt", "set/metas/front/c2.txt", "set/t5_xxl/front/c1.pickle", "set/t5_xxl/front/c2.pickle", "set/videos/front/c1.mp4"]
    assert (tmp_path / "set/metas/front/c1.txt").read_text() == "a caption"


def test_fragments_are_committed_once(spark, tmp_path):
    staging, done, final = (str(tmp_path / n) for n in ("staging", "done", "final"))
    assert fragments.consolidated(spark, staging, done, final) == []
    fragments.stage(spark.range(10), staging, "one")
    fragments.stage(spark.range(10, 15), staging, "two")
    spark.range(99).write.parquet(f"{staging}/failed")  # a run that broke off has no sidecar
    assert fragments.consolidated(spark, staging, done, final) == ["one.json", "two.json"]
    assert fragments.consolidated(spark, staging, done, final) == []
    assert sorted(r.id for r in spark.read.parquet(final).collect()) == list(range(15))
    fragments.stage(spark.range(10), staging, "one")  # its sidecar was committed before
    assert fragments.consolidated(spark, staging, done, final) == []
    fragments.stage(spark.range(3).withColumn("x", F.lit(1)), staging, "odd")
    with pytest.raises(ValueError, match="other columns"):
        fragments.consolidated(spark, staging, done, final)


def test_index_of_many_files_in_one_batch(spark):
    """Packets of files laid end to end: those of a file stay its own, also beside files that are none, and over parts."""

    def video(n, step=1):
        return packets.muxed([(bytes(i % 5 + 1), (i ^ 1 if i ^ 1 < n else i) * step, i * step, i % 4 == 0) for i in range(n)], 1_000_000, 6, 4)

    made = [video(1), b"none", video(7, 2_000_000_000 // 7), None, video(packets.AT_ONCE + 3), video(2), video(0), video(3)[:-9]]
    df = spark.createDataFrame([(i, None if x is None else bytearray(x)) for i, x in enumerate(made)], "k int, content binary").coalesce(1)
    got = {r.k: r for r in packets.indexed(df).collect()}
    assert sorted(got) == list(range(8)) and [k for k, r in got.items() if r.errors] == [1, 3, 6, 7] == [k for k, r in got.items() if r.packets is None and r.metadata is None]
    for k in (0, 2, 4, 5):
        t = packets.mp4_track(made[k])
        want = sorted(t.packets, key=lambda p: p.pts)
        assert [tuple(p) for p in got[k].packets] == [(p.pts, p.dts, p.pts * 1000, p.offset, p.size, p.is_key) for p in want]
        assert [made[k][p.offset : p.offset + p.size] for p in t.packets] == [bytes(i % 5 + 1) for i in range(len(want))]
        assert got[k].metadata.num_frames == len(want) and got[k].metadata.width == 6


def test_a_timescale_of_0_is_the_file_s_error(spark):
    data = bytearray(packets.muxed([(b"x", 0, 0, True)], 30))
    at = data.index(b"mdhd") + 4 + 12
    data[at : at + 4] = bytes(4)
    row = packets.indexed(spark.createDataFrame([(data,)], "content binary")).first()
    assert row.packets is None and "timescale" in row.errors["probe"]
