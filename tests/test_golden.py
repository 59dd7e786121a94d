"""Golden cases of each operator, by hand."""

import math
import uuid

import pytest
from pyspark.sql import functions as F

from skein.functions import geometry, ids, text, vectors
from skein.operators import align, catalog, frames, grouping, kernels, records, routing, semdedup, spans, summary, tracks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def pairs(x):
    return [tuple(s) for s in x]


@pytest.mark.parametrize(
    ("end", "length", "stride", "least", "want"),
    [
        (30.0, 10.0, 10.0, 5.0, [(0, 10), (10, 20), (20, 30)]),
        (30.0, 10.0, 5.0, 5.0, [(0, 10), (5, 15), (10, 20), (15, 25), (20, 30), (25, 30)]),
        (12.0, 10.0, 10.0, 8.0, [(0, 10)]),
        (0.0, 10.0, 10.0, 0.0, []),
    ],
)
def test_fixed_stride(spark, end, length, stride, least, want):
    assert pairs(one(spark, spans.fixed_stride(F.lit(0.0), F.lit(end), length, stride, least))) == want


@pytest.mark.parametrize(("total", "want"), [(3, []), (4, [(0, 3)]), (8, [(0, 3), (4, 7)]), (9, [(0, 3), (4, 8)]), (10, [(0, 3), (4, 7), (8, 9)])])
def test_caption_windows(spark, total, want):
    assert pairs(one(spark, spans.caption_windows(F.lit(total).cast("long"), 4, 2))) == want


@pytest.mark.parametrize(("flags", "want", "whole"), [("001100", [(0, 2), (4, 5)], [(0, 2), (4, 5)]), ("100", [], [(0, 3)]), ("000", [], [(0, 3)]), ("0110111", [(0, 1), (3, 4)], [(0, 1), (3, 4)])])
def test_scenes(spark, flags, want, whole):
    df = spark.createDataFrame([(1, i, int(c)) for i, c in enumerate(flags)], "k int, i int, f int")
    for w, expect in ((False, want), (True, whole)):
        assert sorted((r.start, r.end) for r in spans.scenes(df, "k", ["i"], "f", w).collect()) == expect


def test_scene_filters(spark):
    df = spark.createDataFrame([(1, 0, 25), (1, 30, 33)], "k int, start long, end long")
    get = lambda **k: sorted((r.start, r.end) for r in spans.filtered_scenes(df, **k).collect())
    assert get(max_length=10) == [(0, 10), (30, 33)]
    assert get(max_length=10, mode="stride", min_length=4) == [(0, 10), (10, 20), (20, 25)]
    assert get(max_length=10, mode="stride") == [(0, 10), (10, 20), (20, 25), (30, 33)]
    assert get(crop=2) == [(2, 23)]


def test_packing_and_chunks(spark):
    sizes = [4, 5, 2, 12, 1]
    df = spark.createDataFrame([("a", i, n) for i, n in enumerate(sizes)] + [("b", 0, 50), (None, 0, None)], "k string, i int, n int")
    made = grouping.packed(df, "k", ["i"], "n", 10)
    assert [r.group_no for r in made.filter("k = 'a'").orderBy("i").collect()] == [0, 0, 1, 2, 3]
    left = grouping.drop_small_last(made, "k", 2).collect()
    assert sorted((r.i, r.group_no) for r in left if r.k == "a") == [(0, 0), (1, 0), (2, 1), (3, 2)]
    df = spark.createDataFrame([("a", i, n) for i, n in enumerate([2, 1, 2, 1, 1])], "k string, i int, n int")
    assert [r.group_no for r in grouping.closed_on_reach(df, "k", ["i"], "n", 3).orderBy("i").collect()] == [0, 0, 1, 1, 2]


@pytest.mark.parametrize(("rows", "n", "want"), [(10, 3, [4, 3, 3]), (2, 5, [1, 1]), (7, 7, [1] * 7)])
def test_near_equal(spark, rows, n, want):
    made = grouping.near_equal(spark.range(rows), ["id"], n).groupBy("chunk").agg(F.count("*").alias("n"), F.min("id").alias("lo")).orderBy("chunk").collect()
    assert [r.n for r in made] == want and [r.lo for r in made] == [sum(want[:i]) for i in range(len(want))]


def test_part_numbers(spark):
    groups = spark.createDataFrame([("a", g) for g in range(5)] + [("b", 0)], "k string, group_no long")
    old = spark.createDataFrame([("a", 3), ("a", 1)], "k string, part int")
    got = {(r.k, r.group_no): (r.part, r.tar) for r in grouping.numbered_parts(groups, "k", old, 2).collect()}
    assert got == {("a", 0): (4, 0), ("a", 1): (4, 1), ("a", 2): (5, 0), ("a", 3): (5, 1), ("a", 4): (6, 0), ("b", 0): (0, 0)}


def test_bins(spark):
    b = lambda w, h, s: one(spark, geometry.video_bin(F.lit(w), F.lit(h), F.lit(s), F.lit(1.0)))
    assert b(1920, 1080, 8) == "16_9/1080/5_10" and b(1920, 1080, 50) == "16_9/1080/30_inf"
    assert b(640, 480, 15) == "4_3/lt_720/10_30"
    assert [b(1600, 900, s) for s in (7, 20, 100)] == ["16_9/720/5_10", "16_9/720/10_30", "16_9/720/30_inf"]
    assert b(1920, 1080, 10) == "16_9/1080/5_10" and b(1920, 1080, 4) is None and b(10000, 100, 20) is None
    assert one(spark, geometry.aspect_bin(F.lit(400), F.lit(300))) == "4:3"


def test_resize_and_boxes(spark):
    s = one(spark, geometry.smart_resize(F.lit(1920), F.lit(1080), 28, 3136, 1_003_520))
    assert s.width % 28 == 0 and s.height % 28 == 0 and s.width * s.height <= 1_003_520
    with pytest.raises(Exception, match="aspect ratio"):
        one(spark, geometry.smart_resize(F.lit(3000), F.lit(10), 28, 3136, 1_003_520))
    box = lambda *x: F.struct(*(F.lit(float(v)).alias(n) for v, n in zip(x, ("x0", "y0", "x1", "y1"))))
    assert one(spark, geometry.iou(box(0, 0, 2, 2), box(1, 0, 3, 2))) == pytest.approx(1 / 3)
    assert one(spark, geometry.iou(box(0, 0, 0, 0), box(0, 0, 0, 0))) == 0
    assert tracks.box_iou((0, 0, 2, 2), (1, 0, 3, 2)) == pytest.approx(1 / 3)


def test_nearest(spark):
    def get(samples, points):
        s = spark.createDataFrame([(1, t) for t in samples], "k int, t long")
        p = spark.createDataFrame([(1, t) for t in points], "k int, p long")
        return [samples.index(r.t) for r in align.nearest(s, p, "k", "t", "p").orderBy("p").collect()]

    assert get([0, 10], [5]) == [0]
    assert get([10, 20], [0, 5]) == [0, 0] and get([10, 20], [25, 30]) == [1, 1]
    assert get([10], [0, 10, 20]) == [0, 0, 0]


def test_window_samples(spark):
    s = spark.createDataFrame([(1, t) for t in (100, 200, 300, 400)], "k int, t long")
    w = spark.createDataFrame([(1, 0, 150, 350)], "k int, idx long, start long, end long")
    p = spark.createDataFrame([(1, 0, 150), (1, 0, 260)], "k int, idx long, p long")
    assert sorted((r.t, r.n) for r in align.window_samples(s, w, p, "k").collect()) == [(200, 1), (300, 1)]
    p = spark.createDataFrame([(1, 0, 110), (1, 0, 140), (1, 0, 240)], "k int, idx long, p long")
    s = spark.createDataFrame([(1, t) for t in (100, 200, 300)], "k int, t long")
    w = spark.createDataFrame([(1, 0, 100, 300)], "k int, idx long, start long, end long")
    assert [(r.t, r.n) for r in align.window_samples(s, w, p, "k").collect()] == [(200, 3)]
    with pytest.raises(Exception, match="tolerance exceeded"):
        align.window_samples(s, w, p, "k", tolerance=10).collect()


def test_time_windows(spark):
    get = lambda *a: [tuple(x) for x in one(spark, align.windows(F.lit(a[0]).cast("long"), F.lit(a[1]).cast("long"), a[2], a[3]))]
    assert get(0, 10, 4, 4) == [(0, 0, 4), (1, 4, 8), (2, 8, 10)]
    assert get(0, 10, 6, 4) == [(0, 0, 6), (1, 4, 10), (2, 8, 10)]
    assert get(0, 10, 2, 5) == [(0, 0, 2), (1, 5, 7)]
    assert get(7, 7, 3, 3) == [(0, 7, 7)]


def test_pts(spark):
    get = lambda p: one(spark, align.pts_to_ns(F.lit(p).cast("long"), 1, 90_000))
    for p in (0, 1, -1, 12345, -98765, 9_223_372_036):
        assert get(p) == p * 10**9 // 90_000


def test_uuids(spark):
    for t in ("", "a/b.mp4", "é☃"):
        assert one(spark, ids.uuid5(F.lit(t))) == str(uuid.uuid5(uuid.NAMESPACE_URL, t))
    assert one(spark, ids.clip_uuid(F.lit("s"), F.lit(0.0), F.lit(10.0))) == str(uuid.uuid5(uuid.NAMESPACE_URL, "s_0.0_10.0"))
    assert one(spark, ids.part_number(ids.part_path(F.lit(12)))) == 12


def test_tolerant_json(spark):
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    get = lambda t: one(spark, text.tolerant_map(F.lit(t)))
    assert get('x <think>{"a": "no"}</think> <answer>{"synthetic image": "yes"}</answer>}') == {"synthetic_image": "yes"}
    assert get('{"a": "1"\n"b": "2"}') == {"a": "1", "b": "2"}
    assert get('{"a": {"b": "c"}} {"d": 1}') == {"a": '{"b":"c"}'}
    assert get("{ never closed") is None and get("nothing") is None and get('{"a": }') is None
    assert one(spark, text.tolerant_map(F.lit(None).cast("string"))) is None


def test_text_rules(spark):
    k = lambda t: one(spark, text.keyword_in_caption(F.lit(t), text.KEYWORD))
    assert not k("Picking up groceries") and not k("International Airport") and k("Drop-off at the AIRPORT")
    assert one(spark, text.comma_list(F.lit(" a, ,b,"))) == ["a", "b"]
    assert one(spark, text.relative_path(F.lit("s3://b/in/x/y.mp4"), "s3://b/in")) == "x/y.mp4"
    assert one(spark, text.relative_path(F.lit("s3://b/inn/y.mp4"), "s3://b/in/")) == "s3://b/inn/y.mp4"
    status = lambda f, t: one(spark, text.caption_status(F.lit(f), F.lit(t).cast("string")))
    assert [status("stop", "x"), status("length", "x"), status("length", ""), status("content_filter", "x"), status("stop", None)] == ["success", "truncated", "error", "blocked", "error"]
    parts = one(spark, text.condition_tags(F.lit("**Visibility Condition:** good.\n**Road Surface Condition:** wet. **Illumination Condition:** on...")))
    assert parts.asDict() == {"visibility": "good", "road_condition": "wet", "illumination": "on"}
    assert one(spark, text.condition_tags(F.lit("nothing"))) is None
    events = lambda t: one(spark, text.events_payload(F.lit(t)))
    assert events('```json\n{"events": [{"a": 1}, 2]}\n```') == ['{"a":1}', "2"]
    assert events('so: {"events": [1]} done') == ["1"] and events("[1, 2] and") == ["1", "2"] and events("none") == [] and events('{"x": 1}') == []
    assert one(spark, text.event_prompt("{instances} in {duration} s", F.array(F.struct(F.lit(1).alias("id"))), F.lit(2))) == '[{"id":1}] in 2.0 s'
    assert one(spark, text.with_error(F.lit(None).cast("map<string,string>"), "a", F.lit("bad"))) == {"a": "bad"}


def test_semantic_and_classifier(spark):
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    w = spark.createDataFrame([(1, '{"synthetic image": "yes"}'), (2, "broken"), (3, '{"synthetic image": "no"}')], "k int, a string")
    clips = spark.createDataFrame([(i,) for i in range(1, 5)], "k int")
    got = {r.k: (r.passes, r.issues, r.error) for r in routing.semantic_verdicts(clips, w, "k", "a", ["synthetic image"], 0.5).collect()}
    assert got == {1: (False, ["synthetic image"], None), 2: (False, [], "malformed_model_output"), 3: (True, [], None), 4: (False, None, "all_windows_failed_preparation")}
    assert all(r.passes for r in routing.semantic_verdicts(clips, w, "k", "a", ["synthetic image"], 0.5, score_only=True).collect())
    w = spark.createDataFrame([(1, '{"planet_earth": "yes", "space": "no"}'), (2, "broken"), (3, '{"space": "yes"}')], "k int, a string")
    got = {r.k: (r.passes, r.labels, r.issues) for r in routing.classifier_verdicts(w, "k", "a", ["planet_earth"], ["space"], ["planet_earth", "space"], 0.0, True).collect()}
    assert got == {1: (True, ["planet_earth"], []), 2: (False, ["unclassified"], []), 3: (False, ["space"], ["space"])}


def test_routing_keeps_the_first_reason(spark):
    df = spark.createDataFrame([(1, 0.1, 0.1), (2, 0.9, 0.1), (3, 0.5, 0.9), (4, None, 0.9)], "k int, a double, b double")
    df = routing.reject(df, routing.aesthetic(F.when(F.col("a").isNotNull(), F.array("a")), 0.5), "aesthetic")
    df = routing.reject(df, routing.motion(F.col("b"), F.lit(1.0), 0.5, 0.5), "motion")
    assert {r.k: r.stage_rejected for r in df.collect()} == {1: "aesthetic", 2: "motion", 3: None, 4: "aesthetic"}


def test_semdedup_tiles_and_ties(spark, monkeypatch):
    monkeypatch.setattr(semdedup, "TILE", 3)
    monkeypatch.setattr(semdedup, "STEP", 2)
    rows = [(i, 0 if i < 8 else 1, [math.cos(i % 4), math.sin(i % 4)]) for i in range(11)]
    df = spark.createDataFrame(rows, "id long, c int, v array<double>")
    made = semdedup.ranked(df, "id", "c", "v", semdedup.centroids(df, "c", "v"))
    rank = {r.id: r["rank"] for r in made.collect()}
    got = {r.id: (r.max_id, round(r.cosine_sim_score, 9)) for r in semdedup.max_earlier(made, "id", "c").collect()}
    for i, c, v in rows:
        earlier = [(j, round(sum(a * b for a, b in zip(v, w)), 9)) for j, k, w in rows if k == c and rank[j] < rank[i]]
        want = max(earlier, key=lambda x: (x[1], -rank[x[0]]), default=(i, 0.0))
        assert got[i] == want
    twins = spark.createDataFrame([(1, 0, [1.0, 0.0]), (2, 0, [1.0, 0.0])], "id long, c int, v array<double>")
    scored = semdedup.max_earlier(semdedup.ranked(twins, "id", "c", "v", semdedup.centroids(twins, "c", "v")), "id", "c")
    assert sorted((r.id, r.max_id, r.cosine_sim_score) for r in scored.collect()) == [(1, 1, 0.0), (2, 1, 1.0)]
    assert [(r.kept, r.removed, r.total) for r in semdedup.eps_summary(scored, [0.01]).collect()] == [(1, 1, 2)]
    with pytest.raises(ValueError):
        vectors.assert_one_length(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "v array<double>"), "v")


def test_cameras_and_catalog(spark):
    df = spark.createDataFrame([("s", "b"), ("s", "front"), ("s", "a"), ("t", "x")], "s string, p string")
    got = sorted((r.s, r.camera_rank, r.p) for r in catalog.primary_first(df, "s", "p", "front", strict=False).collect())
    assert got == [("s", 0, "front"), ("s", 1, "a"), ("s", 2, "b"), ("t", 0, "x")]
    with pytest.raises(Exception, match="primary paths"):
        catalog.primary_first(df, "s", "p", "front").collect()
    with pytest.raises(ValueError):
        catalog.assert_unique(df, "s")
    assert catalog.schema_changes({"a": "int", "b": "int"}, {"a": "long", "c": "int"}) == [("add", "c", "int"), ("drop", "b", "int"), ("alter", "a", "long")]


def test_session_clips_and_chains(spark):
    df = spark.createDataFrame([("s", 1, ["clip-3"], 7.0), ("s", 0, ["clip-1", "clip-2"], 12.5)], "s string, i int, clips array<string>, d double")
    assert [tuple(r) for r in summary.session_clips(df, "s", "i", "clips", "d").collect()] == [("s", ["clip-1", "clip-2", "clip-3"], 12.5)]
    df = spark.createDataFrame([(1, i, f"t{i}") for i in range(4)], "k int, i int, t string")
    got = sorted((r.prompt_type, r.t) for r in summary.caption_chain(df, ["k"], "i", "t", "v").collect())
    assert got == [("v", "t3"), ("v_000", "t2"), ("v_001", "t1"), ("v_002", "t0")]


def test_tracks(spark):
    boxes = [("c", f, 0.0, 0.0, 10.0, 10.0) for f in (0, 2, 4)] + [("c", 20, 0.0, 0.0, 10.0, 10.0), ("c", 2, 50.0, 50.0, 60.0, 60.0)]
    df = spark.createDataFrame(boxes, "c string, frame int, x0 double, y0 double, x1 double, y1 double")
    got = sorted((r.first, r.last, r.n) for r in tracks.text_tracks(df, "c", 2).collect())
    assert got == [(0, 4, 3), (2, 2, 1), (20, 20, 1)]
    assert tracks.corner_share(df, "c", 100.0, 100.0).first().share == 1.0


def test_kernels(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "boom")], "k int, t string").coalesce(1)
    made = kernels.with_kernel(df, kernels.HashEmbedding("t", 4)).collect()
    assert all(len(r.embedding) == 4 and r.kernel_error is None for r in made)

    class Broken(kernels.HashEmbedding):
        def run(self, batch):
            if "boom" in batch.column("t").to_pylist():
                raise RuntimeError("boom")
            return super().run(batch)

    made = {r.k: (r.embedding is None, r.kernel_error) for r in kernels.with_kernel(df, Broken("t", 4), batch_rows=1).collect()}
    assert made == {1: (False, None), 2: (False, None), 3: (True, "RuntimeError: boom")}

    async def call(value):
        if value == "boom":
            raise ValueError("no")
        return f"<{value}>"

    made = {r.k: (r.answer, r.answer_error) for r in kernels.with_kernel(df, kernels.AsyncCalls("t", call)).collect()}
    assert made == {1: ("<a>", None), 2: ("<None>", None), 3: (None, "ValueError: no")}


def test_compared(spark):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, None), (3, 3.0, "z")], "k int, v double, s string")
    b = spark.createDataFrame([(1, 1.05, "x"), (2, 2.5, None), (4, 4.0, "w")], "k int, v double, s string")
    got = {r.field: r.n_different for r in kernels.compared(a, b, "k", 0.1).collect()}
    assert got == {"_row": 2, "v": 1, "s": 0}


def test_scattered(spark):
    clips = spark.createDataFrame([(1, 0), (1, 1)], "c int, w int")
    good = spark.createDataFrame([(1, 0, "a"), (1, 1, None)], "c int, w int, t string")
    assert sorted((r.w, r.t) for r in frames.scattered(clips, good, ["c", "w"], "t").collect()) == [(0, "a"), (1, None)]
    with pytest.raises(Exception, match="no answer"):
        frames.scattered(clips, good.filter("w = 0"), ["c", "w"], "t").collect()


def test_strides_skip_uneven_indices(spark):
    even = [float(100 * i) for i in range(40)]
    jump = even[:15] + [x + 250 for x in even[15:]]
    df = spark.createDataFrame([("s", 0, even, 10.0), ("s", 1, jump, 10.0)], "s string, cam int, ts array<double>, fps double")
    get = lambda **k: sorted({r.idx for r in frames.aligned_strides(df, "s", "cam", "ts", "fps", 10, 10, **k).collect()})
    assert get(verify=False) == [0, 1, 2] and get() == [0, 2] and get(limit=2) == [0]


def test_small_helpers(spark):
    assert frames.lcm_rate([2, 3.0, 4]) == 12
    assert one(spark, frames.weight(F.lit(600.0), F.lit(1), F.lit(2))) == 1.0
    assert one(spark, spans.middle_frame(F.array(*(F.lit(i) for i in range(4))))) == 1
    assert one(spark, spans.every_kth(F.array(*(F.lit(i) for i in range(7))), 3)) == [0, 3, 6]
    assert one(spark, text.first_present(F.create_map(F.lit("b"), F.lit("x")), ["a", "b"])) == "x"
    assert one(spark, text.all_captions(F.array(F.create_map(F.lit("a"), F.lit("1")), F.create_map(F.lit("a"), F.lit("2"))))) == ["1", "2"]


def test_records(spark):
    with pytest.raises(Exception, match="unexpected frame count"):
        one(spark, records.prompts_for(F.lit(3), F.create_map(F.lit("default"), F.lit("p")), 256, 57))
    df = spark.createDataFrame([([1, 2, 3], [1.0]), ([2, 2], [float("nan")]), ([], [])], "t array<long>, v array<double>")
    assert [r.x for r in df.select(records.rising(F.col("t")).alias("x")).collect()] == [True, False, True]
    assert [r.x for r in df.select(records.finite(F.col("v")).alias("x")).collect()] == [True, False, True]
    with pytest.raises(ValueError, match="'rising': 1"):
        records.assert_valid(df, rising=records.rising(F.col("t")), any=F.lit(True))
    records.assert_valid(df, any=F.lit(True))
    with pytest.raises(Exception, match="no rising grid"):
        one(spark, records.time_grid(F.lit(0).cast("long"), F.lit(10).cast("long"), 1e10))
    assert one(spark, records.time_grid(F.lit(0).cast("long"), F.lit(10**9).cast("long"), 4.0)) == [0, 250_000_000, 500_000_000, 750_000_000, 10**9]
    assert one(spark, records.envelope("events", F.array(F.lit(1)))) == '{"events":[1]}'
    assert records.sampled(spark.range(1000), "id", 5.0).count() == 1000 and records.sampled(spark.range(1000), "id", -1).count() == 0
    assert one(spark, records.nested_bytes(F.lit("é"), F.lit(None).cast("string"))) == 2


def test_floats_are_written_as_in_python(spark):
    import random

    from skein.functions import ids

    rng = random.Random(4)
    values = [0.0, -0.0, 1.0, 0.5, 1e7, 12345678.5, -98765432.125, 1e15, 1234567890123456.0, 1e16, 1.5e16, 1e22, 0.001, 0.0001, 0.00012345, 0.00001, 1.5e-5, -2.5e-7, 1e-100, 1.7e308, float("nan"), float("inf"), float("-inf")]
    values += [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-3, 20) for _ in range(300)]
    rows = spark.createDataFrame([(x,) for x in values], "x double").select("x", ids.float_text(F.col("x")).alias("t")).collect()
    assert [r.t for r in rows] == [repr(r.x) for r in rows]
