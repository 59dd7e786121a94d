"""Records that leave a pipeline and the checks on what enters one: validity, metadata rows, envelopes, traces, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.text import tolerant_map
from skein.sources import embedded

# Caption states that count as captions, and pixel formats that hardware decodes for each codec.
CAPTIONED = ("success", "truncated")
DECODES = {"h264": ("nv16", "420p"), "hevc": ("420p", "444p")}


def validity(clips: DataFrame, windows: DataFrame, key: str, n_bytes: str, status: str, tokens: list[str]) -> DataFrame:
    """``clips`` with ``valid`` (bytes and a window), ``has_caption`` and the sums of the token columns."""
    sums = windows.groupBy(key).agg(F.count("*").alias("__n"), F.bool_or(F.col(status).isin(*CAPTIONED)).alias("has_caption"), *(F.sum(c).alias(f"total_{c}") for c in tokens))
    out = clips.join(sums, key, "left").withColumn("valid", F.coalesce((F.col(n_bytes) > 0) & (F.col("__n") > 0), F.lit(False)))
    return out.drop("__n").fillna(False, ["has_caption"]).fillna(0, [f"total_{c}" for c in tokens])


def metadata_json(clips: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, json) of a metadata row; keys whose value is null are left out."""
    return clips.select(key, F.to_json(F.struct(*columns), {"ignoreNullFields": "true"}).alias("json"))


def envelope(name: str, items: Column) -> Column:
    """A list, or a map by frame number, under one name, as JSON."""
    return F.to_json(F.struct(items.alias(name)))


def image_verdict(caption: Column, status: Column, criteria: list[str], stage: str = "semantic") -> Column:
    """struct(rejected, stage, error) of an image with one filter caption.

    Without a caption it is rejected, with an error unless the answer was blocked or failed; a malformed one is rejected
    with an error; else it is rejected if any criterion is "yes".
    """
    m = tolerant_map(caption)
    hit = F.lit(False)
    for c in criteria:
        hit = hit | (F.coalesce(m[c.replace(" ", "_")], F.lit("no")) == "yes")
    known = F.coalesce(status.isin("blocked", "error"), F.lit(False))
    rejected = F.when(caption.isNull() | m.isNull(), True).otherwise(hit)
    error = F.when(caption.isNull() & ~known, "all_windows_failed_preparation").when(caption.isNotNull() & m.isNull(), "malformed_model_output")
    return F.struct(rejected.alias("rejected"), F.when(rejected, stage).alias("stage"), error.alias("error"))


def hardware_decodes(codec: Column, pixel_format: Column) -> Column:
    out = F.lit(False)
    for name, formats in DECODES.items():
        out = out | ((codec == name) & pixel_format.rlike("|".join(formats)))
    return F.coalesce(out, F.lit(False))


def ten_bit(pixel_format: Column) -> Column:
    """Whether a pixel format has 10 bits; null for null."""
    return pixel_format.rlike("10le|10be")


def prompts_for(frames: Column, prompts: Column, clip_frames: int, front_frames: int) -> Column:
    """All prompts for a whole clip, the default one for a front window; any other frame count is an error."""
    default = F.map_filter(prompts, lambda k, _: k == "default")
    wrong = F.raise_error(F.concat(F.lit("unexpected frame count: "), frames.cast("string")))
    return F.when(frames == clip_frames, prompts).when(frames == front_frames, default).otherwise(wrong)


def camera_number(name: Column, delimiter: str, index: int) -> Column:
    """The number in one part of a file name such as cam-07-x.h264."""
    return F.get(F.split(name, "\\Q" + delimiter + "\\E"), F.lit(index)).cast("int")


def time_grid(start: Column, end: Column, rate_hz: float) -> Column:
    """Sample times in ns from ``start`` up to ``end`` at a rate, computed in seconds and rounded half to even.

    A rate that gives equal neighbours after rounding is an error.
    """
    step = 1.0 / rate_hz
    n = F.floor((end / 1e9 - start / 1e9) / step + 1e-12).cast("int") + 1
    points = F.transform(F.sequence(F.lit(0), n), lambda i: F.bround((start / 1e9 + i * F.lit(step)) * 1e9).cast("long"))
    rising = F.forall(F.zip_with(F.slice(points, F.lit(1), n), F.slice(points, F.lit(2), n), lambda a, b: b > a), lambda x: x)
    return F.when(rising, F.slice(points, F.lit(1), n)).otherwise(F.raise_error(F.lit("the rate gives no rising grid")).cast("array<long>"))


def assert_valid(df: DataFrame, **rules: Column) -> None:
    """Error naming each rule that any row breaks, with how many; a null verdict breaks it."""
    counts = df.agg(*(F.count_if(~F.coalesce(rule, F.lit(False))).alias(n) for n, rule in rules.items())).first().asDict()
    if broken := {n: c for n, c in counts.items() if c}:
        raise ValueError(f"invalid rows: {broken}")


def rising(values: Column) -> Column:
    """Whether an array rises strictly."""
    n = F.size(values)
    return (n < 2) | F.forall(F.zip_with(F.slice(values, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(values, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: b > a), lambda x: x)


def finite(values: Column) -> Column:
    return F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))


def trace_spans(lines: DataFrame) -> DataFrame:
    """name, ids and times in ns of JSON trace lines; lines that do not parse are left out.

    Times keep all nine digits of their fraction: the JVM's timestamps have six.
    """
    j = F.from_json("value", "name string, context struct<trace_id:string,span_id:string>, start_time string, end_time string")
    hexed = lambda c: F.when(c.isNull() | (c == ""), "0").otherwise(F.regexp_replace(F.lower(c), "^0x0*(?=.)", ""))
    whole = lambda c: F.unix_seconds(F.try_to_timestamp(F.regexp_replace(c, r"\.\d+", "")))
    ns = lambda c: whole(c) * 1_000_000_000 + F.rpad(F.regexp_extract(c, r"\.(\d{1,9})", 1), 9, "0").cast("long")
    rows = lines.withColumn("j", j).filter(F.col("j.name").isNotNull())
    return rows.select(F.col("j.name").alias("name"), hexed(F.col("j.context.trace_id")).alias("trace_id"), F.conv(hexed(F.col("j.context.span_id")), 16, 10).alias("span_id"), ns(F.col("j.start_time")).alias("start_ns"), ns(F.col("j.end_time")).alias("end_ns"))


def sampled(rows: DataFrame, key: str, rate: float, seed: int = 0) -> DataFrame:
    """Rows whose key's hash falls below the rate, held to [0, 1]: the same rows whatever the partitioning."""
    share = min(1.0, max(0.0, rate))
    drawn = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long")
    return rows.filter(drawn < int(share * (1 << 32)))


def nested_bytes(*columns: Column) -> Column:
    """Bytes of strings and binaries of a row, nulls counting nothing."""
    return sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(0))


def append_run(df: DataFrame, url: str, table: str, run: str, limit: str = "LIMIT 1", **options: str) -> None:
    """Appends rows to a database table under a run id, unless the run is there already: a retry changes nothing.

    ``limit`` is how the database's dialect asks for one row. The run id is a value, quoted as such. Database files are
    written by the driver (:mod:`skein.sources.embedded`), all others by the executors.
    """
    spark: SparkSession = df.sparkSession
    value = run.replace("'", "''")
    query, rows = f"SELECT 1 AS x FROM {table} WHERE \"run_uuid\" = '{value}' {limit}", df.withColumn("run_uuid", F.lit(run))
    if embedded.is_embedded(url):
        if not embedded.has_row(spark, url, table, query, **options):
            embedded.append(rows, url, table, **options)
    elif spark.read.format("jdbc").option("url", url).options(**options).option("query", query).load().isEmpty():
        rows.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode("append").save()
