"""Reading the driver's tables, which stand in for recordings, sessions, clips and captions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(column: str) -> Column:
    """Microseconds since the epoch of a timestamp without zone, read as UTC."""
    return F.unix_micros(F.col(column).cast("timestamp"))


def joined(array: Column, sep: str = ",") -> Column:
    """An array as text, for results that other engines print too."""
    return F.array_join(F.transform(array, lambda x: x.cast("string")), sep)
