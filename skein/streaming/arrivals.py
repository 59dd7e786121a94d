"""Arrivals as streams: new files through the same plans, exactly once, and windows over event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def arriving(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files that keep arriving; ``path`` may be a pattern."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def process(stream: DataFrame, checkpoint: str, work: Callable[[DataFrame], DataFrame], target: str, key: str, once: bool = True) -> StreamingQuery:
    """Each micro-batch through ``work``, rows of new keys appended to ``target``; a batch run again adds nothing."""
    from skein.sources.sinks import append_new

    def each(batch: DataFrame, _: int) -> None:
        append_new(work(batch), target, key)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def first_arrivals(stream: DataFrame, key: str, time: str, late: str) -> DataFrame:
    """The first row of each key within the watermark's delay; state older than that is let go."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def window_counts(rows: DataFrame, time: str, width: str, slide: str, by: str, late: str | None = None) -> DataFrame:
    """Rows and key in epoch-aligned windows; with ``late``, windows close that long after their end."""
    timed = rows.withWatermark(time, late) if late else rows
    counted = timed.groupBy(F.window(time, width, slide), by).agg(F.count("*").alias("n_rows"))
    return counted.select(F.col("window.start").alias("start"), by, "n_rows")


def sessions(rows: DataFrame, time: str, gap: str, by: str, late: str | None = None) -> DataFrame:
    """Sessions of a key: runs of rows less than a gap apart, with their ends and size."""
    timed = rows.withWatermark(time, late) if late else rows
    made = timed.groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count("*").alias("n_rows"), F.min(time).alias("first"), F.max(time).alias("last"))
    return made.select(by, "first", "last", "n_rows")


def drained(stream: DataFrame, folder: str, name: str, mode: str = "complete") -> DataFrame:
    """What a streaming aggregate holds after all input that is there: run once, written below a shared folder, read back."""
    spark = stream.sparkSession

    def each(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{name}/rows")

    query = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", f"{folder}/{name}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/{name}/rows")
