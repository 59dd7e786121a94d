"""Time alignment queries on the events, a user or an event type as a sensor, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators import align
from skein.plans.tables import joined, micros, table

HOUR = 3_600_000_000


def _times(spark: SparkSession, d: str, *more: str) -> DataFrame:
    return table(spark, d, "events").select("user_id", micros("ts").alias("t"), *more)


def asof_nearest(spark: SparkSession, d: str) -> DataFrame:
    """The nearest event of a user to each point of a grid of 12 hours over the user's time, the earlier on ties."""
    ev = _times(spark, d).distinct()
    ends = ev.groupBy("user_id").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    points = ends.select("user_id", F.explode(align.grid(F.col("lo"), F.col("hi"), 12 * HOUR)).alias("p"))
    return align.nearest(ev, points, "user_id", "t", "p")


ASOF_SQL = f"""WITH e AS (SELECT DISTINCT user_id, epoch_us(ts) AS t FROM events), b AS (SELECT user_id, min(t) AS lo, max(t) AS hi FROM e GROUP BY user_id),
g AS (SELECT user_id, lo + i * {12 * HOUR} AS p FROM b, generate_series(0, 20000) AS s(i) WHERE lo + i * {12 * HOUR} <= hi),
l AS (SELECT g.user_id, p, e.t AS before FROM g ASOF LEFT JOIN e ON g.user_id = e.user_id AND g.p >= e.t),
r AS (SELECT l.user_id, p, before, e.t AS after FROM l ASOF LEFT JOIN e ON l.user_id = e.user_id AND l.p < e.t)
SELECT user_id, p, CASE WHEN before IS NULL THEN after WHEN after IS NULL OR p - before <= after - p THEN before ELSE after END AS t FROM r"""


def _spans(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events, windows of 5 days every 3 days from each user's first event, and their points every 6 hours."""
    ev = _times(spark, d).distinct()
    ends = ev.groupBy("user_id").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    spans = ends.select("user_id", F.inline(align.windows(F.col("lo"), F.col("hi"), 120 * HOUR, 72 * HOUR)))
    points = spans.select("user_id", "idx", F.explode(align.grid(F.col("start"), F.col("end"), 6 * HOUR, inclusive=False)).alias("p"))
    return ev, spans, points


def window_sample(spark: SparkSession, d: str) -> DataFrame:
    """In sliding windows the distinct events nearest to the points, and how many points each has."""
    ev, spans, points = _spans(spark, d)
    return align.window_samples(ev, spans, points, "user_id")


WINDOWS = f"""e AS (SELECT DISTINCT user_id, epoch_us(ts) AS t FROM events), b AS (SELECT user_id, min(t) AS lo, max(t) AS hi FROM e GROUP BY user_id),
w AS (SELECT user_id, i AS idx, lo + i * {72 * HOUR} AS s, least(lo + i * {72 * HOUR} + {120 * HOUR}, hi) AS z FROM b, generate_series(0, 5000) AS g(i) WHERE lo + i * {72 * HOUR} < hi OR (lo = hi AND i = 0))"""
SAMPLE_SQL = f"""WITH {WINDOWS}, p AS (SELECT user_id, idx, s, z, s + j * {6 * HOUR} AS p FROM w, generate_series(0, 19) AS g(j) WHERE s + j * {6 * HOUR} < z),
n AS (SELECT p.user_id, p.idx, p.p, arg_min(e.t, (abs(e.t - p.p), e.t)) AS t FROM p JOIN e ON e.user_id = p.user_id AND e.t >= p.s AND e.t < p.z GROUP BY ALL)
SELECT user_id, idx, t, count(*) AS n FROM n GROUP BY ALL"""


def sensor_align(spark: SparkSession, d: str) -> DataFrame:
    """Each window's sensors (event types) with their readings' numbers; windows without any stay."""
    _, spans, _ = _spans(spark, d)
    readings = _times(spark, d, "event_type", "event_id")
    made = align.aligned(spans, readings, "user_id", "event_type", "event_id")
    return made.select("user_id", "idx", "start", "end", joined(F.array_sort(F.map_keys("frames"))).alias("sensors"), F.aggregate(F.map_values("frames"), F.lit(0), lambda a, x: a + F.size(x)).cast("long").alias("n"))


ALIGN_SQL = f"""WITH {WINDOWS}, a AS (SELECT user_id, epoch_us(ts) AS t, event_type FROM events)
SELECT w.user_id, w.idx, w.s AS start, w.z AS "end", coalesce(string_agg(DISTINCT event_type, ',' ORDER BY event_type), '') AS sensors, count(event_type) AS n
FROM w LEFT JOIN a ON a.user_id = w.user_id AND a.t >= w.s AND a.t < w.z GROUP BY ALL"""


def governing_keyframe(spark: SparkSession, d: str) -> DataFrame:
    """The last key frame (each tenth event) at or before each event of a user."""
    frames = _times(spark, d, "event_id").withColumn("is_key", F.col("event_id") % 10 == 0)
    return align.governing_key_frame(frames, "user_id", ["t", "event_id"], "is_key", "event_id").select("event_id", "key_frame")


KEYFRAME_SQL = """SELECT event_id, coalesce(last_value(CASE WHEN event_id % 10 = 0 THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING),
  first_value(CASE WHEN event_id % 10 = 0 THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS key_frame FROM events"""


def sensor_bounds(spark: SparkSession, d: str) -> DataFrame:
    """First and last reading of each sensor, and its stamps in nanoseconds of a 90 kHz clock."""
    t = F.col("t") % 1_000_000_007
    return _times(spark, d, "event_type").groupBy("event_type").agg(F.min("t").alias("start"), F.max("t").alias("end"), F.sum(align.pts_to_ns(t - 500_000_000, 1, 90_000) % 1000).alias("check"))


BOUNDS_SQL = """SELECT event_type, min(t) AS start, max(t) AS "end", sum(floor(((t % 1000000007) - 500000000)::HUGEINT * 1000000000 / 90000::DOUBLE)::BIGINT % 1000)::BIGINT AS "check" FROM (SELECT event_type, epoch_us(ts) AS t FROM events) e GROUP BY event_type"""


def nearest_frame(spark: SparkSession, d: str) -> DataFrame:
    """For each session of few frames, the index of the frame nearest to its middle."""
    times = _times(spark, d).groupBy("user_id").agg(F.array_sort(F.collect_set("t")).alias("ts"))
    target = F.floor((F.col("ts")[0] + F.element_at("ts", -1)) / 2)
    return times.select("user_id", align.nearest_in_array(F.col("ts"), target).cast("long").alias("frame"))


FRAME_SQL = """WITH e AS (SELECT DISTINCT user_id, epoch_us(ts) AS t FROM events), m AS (SELECT user_id, floor((min(t) + max(t)) / 2.0)::BIGINT AS x FROM e GROUP BY user_id),
r AS (SELECT user_id, t, row_number() OVER (PARTITION BY user_id ORDER BY t) - 1 AS i FROM e)
SELECT r.user_id, arg_min(i, (abs(t - x), i)) AS frame FROM r JOIN m ON m.user_id = r.user_id GROUP BY r.user_id"""

QUERIES = {f.__name__: f for f in (asof_nearest, window_sample, sensor_align, governing_keyframe, sensor_bounds, nearest_frame)}
ORACLES = {"asof_nearest": ASOF_SQL, "window_sample": SAMPLE_SQL, "sensor_align": ALIGN_SQL, "governing_keyframe": KEYFRAME_SQL, "sensor_bounds": BOUNDS_SQL, "nearest_frame": FRAME_SQL}
