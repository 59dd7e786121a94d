"""Stages, registries and programs: what is an error, what is data, and what a configuration leaves out."""

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skein.operators import catalog, kernels, spans, stages, tracks


def echo(**options):
    return kernels.Rowwise("embedding array<float>", lambda content: ([float(len(content) + options.get("more", 0))],), "content")


def test_registry(spark):
    registry = stages.Registry()
    registry.add("embedder", "echo", echo)
    with pytest.raises(ValueError, match="registered already"):
        registry.add("embedder", "echo", echo)
    df = spark.createDataFrame([(1, bytearray(b"abc"))], "k int, content binary")
    made = stages.EMBED_CLIP(df, "echo", registry=registry, kernel_options={"more": 2}).first()
    assert made.embedding == [5.0] and made.errors == {}
    with pytest.raises(ValueError, match=r"no kernel 'other' for 'embedder'; there are \['echo'\]"):
        stages.EMBED_CLIP(df, "other", registry=registry)
    with pytest.raises(ValueError, match="needs"):
        stages.EMBED_CLIP(df.drop("content"), "echo", registry=registry)


def test_every_stage_has_a_name_of_its_own():
    assert len(stages.STAGES) == sum(isinstance(x, stages.Stage) for x in vars(stages).values())


def test_programs(spark):
    registry = stages.Registry()
    registry.add("embedder", "echo", echo)
    add = lambda n: lambda df: df.withColumn("k", F.col("k") * 10 + n)
    steps = [stages.Named("a", add(1)), stages.Named("b", add(2), on=False), stages.Named("c", add(3)), stages.Named("e", stages.using(stages.EMBED_CLIP, "echo", registry=registry))]
    df = spark.createDataFrame([(1, bytearray(b"abc"))], "k int, content binary")
    assert stages.assembled(steps)(df).first().k == 113 and stages.models_of(steps) == ["echo"]
    with pytest.raises(ValueError, match="one name"):
        stages.assembled([*steps, stages.Named("a", add(1))])
    assert stages.assembled([*steps, stages.Named("b", add(4))])(df).first().k == 1134


def test_batches_of_an_array(spark):
    for n in range(8):
        items = F.sequence(F.lit(1), F.lit(n)) if n else F.array().cast("array<int>")
        assert spark.range(1).select(spans.batched(items, 3).alias("b")).first().b == [list(range(1, n + 1))[i : i + 3] for i in range(0, n, 3)]


def test_catalog_administration(spark):
    spark.range(3).withColumn("s", F.lit("x")).createOrReplaceTempView("administered")
    assert {("administered", "id", "bigint"), ("administered", "s", "string")} <= {tuple(r) for r in catalog.described(spark).collect()}
    spark.catalog.dropTempView("administered")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        catalog.evolved(spark.createDataFrame([("x",)], "s string"), {"s": "int"}).collect()


class Failing(kernels.Rowwise):
    """Fails on every row that is no multiple of ``step``; ``calls`` are the sizes of what it was given."""

    def __init__(self, step):
        super().__init__("x bigint", lambda i: (i,), "id")
        self.step, self.calls = step, []

    def run(self, batch):
        self.calls.append(batch.num_rows)
        if batch.column("id")[0].as_py() % self.step:
            raise ValueError("odd")
        return super().run(batch)


def ran(df, kernel, batches, **options):
    """What the function that with_kernel hands to Spark yields for Arrow batches."""

    class Caught:
        schema = df.schema

        def mapInArrow(self, run, schema):  # noqa: N802
            return list(run(iter(batches)))

    return kernels.with_kernel(Caught(), kernel, **options)


def test_single_rows_go_on_in_whole_batches_and_last_failures_do_not_wait(spark):
    batch, kernel = pa.RecordBatch.from_pydict({"id": pa.array(range(1000), pa.int64())}), Failing(2)
    began = time.monotonic()
    made = ran(spark.range(1), kernel, [batch, batch.slice(0, 0)], batch_rows=1)
    assert time.monotonic() - began < 2.5  # 500 pauses of 10 ms took 5 s
    assert kernel.calls == [1] * 1000 and [b.num_rows for b in made] == [1000]
    assert made[0].column("x").to_pylist() == [None if i % 2 else i for i in range(1000)]
    assert made[0].column("kernel_error").to_pylist() == ["ValueError: odd" if i % 2 else None for i in range(1000)]
    large = ran(spark.range(1), kernels.Rowwise("x binary", lambda i: (bytes(400_000),), "id"), [batch.slice(0, 7)], batch_rows=1)
    assert [b.num_rows for b in large] == [3, 3, 1] and [x for b in large for x in b.column("id").to_pylist()] == list(range(7))


def test_answers_of_another_number_are_an_error(spark):
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(4), pa.int64())})
    kernel = kernels.Rowwise("x bigint", lambda i: (i,), "id")
    kernel.run = lambda b: [pa.array(range(1 if b.column("id")[0].as_py() else 3), pa.int64())]
    with pytest.raises(ValueError, match="2 rows went to the kernel"):
        ran(spark.range(1), kernel, [batch], batch_rows=2)


def greedy(boxes, interval):
    """Tracks as text_tracks words them, every track looked at for every box."""
    made = []
    for f, *box in sorted(boxes):
        for t in made:
            if f - t[1] <= tracks.GAP * interval and tracks.box_iou(t[3], box) >= tracks.MIN_IOU:
                t[1:] = f, t[2] + 1, box
                break
        else:
            made.append([f, f, 1, box])
    return [tuple(t[:3]) for t in made]


def test_tracks_of_rows_and_of_groups(spark):
    rng = random.Random(5)
    clips = {k: [(rng.randrange(60), x := rng.choice([0.0, 0.02, 0.5]), 0.0, x + 0.4, 0.2) for _ in range(k * 9)] for k in range(7)}
    rows = spark.createDataFrame(list(clips.items()), "clip_uuid int, boxes array<struct<frame:bigint,x0:double,y0:double,x1:double,y1:double>>")
    each = rows.select("clip_uuid", F.inline("boxes"))
    found = {}
    for r in tracks.text_tracks(each, "clip_uuid", 2).orderBy("clip_uuid", "track").collect():
        found.setdefault(r.clip_uuid, []).append((r.first, r.last, r.n))
    assert found == {k: greedy(b, 2) for k, b in clips.items() if b}
    share = {r.clip_uuid: r.share for r in tracks.corner_share(each, "clip_uuid", 1.0, 1.0).collect()}
    got = rows.select("clip_uuid", tracks.n_tracks(F.col("boxes"), 2).alias("n"), tracks.corner_share_of(F.col("boxes"), 1.0, 1.0).alias("share")).collect()
    assert {r.clip_uuid: (r.n, r.share) for r in got} == {k: (len(greedy(b, 2)), share.get(k)) for k, b in clips.items()}
