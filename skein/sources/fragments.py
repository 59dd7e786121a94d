"""Fragments that are staged first and committed later: Parquet files with a sidecar that lists them.

A run stages its rows below ``staging`` and then writes one sidecar, so a run that failed has none and its files never
count. :func:`consolidated` moves the files of new sidecars into the final table and the sidecars to ``processed``: a
sidecar that is there already is skipped, so running it again changes nothing, and what broke off in between is finished
by the next run, for files that were moved before are not there to be moved.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().endswith(suffix)) if fs.exists(p) else []


def _written(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def _read(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first().value)


def stage(df: DataFrame, staging: str, name: str | None = None) -> str:
    """Rows as fragments and their sidecar; its name."""
    spark = df.sparkSession
    run = name or uuid.uuid4().hex
    df.write.mode("overwrite").parquet(f"{staging}/{run}")
    _written(spark, f"{staging}/{run}.json", json.dumps({"fragments": _names(spark, f"{staging}/{run}", ".parquet"), "schema": df.schema.jsonValue()}))
    return f"{run}.json"


def consolidated(spark: SparkSession, staging: str, processed: str, final: str) -> list[str]:
    """Commits the staged fragments that were not; the sidecars committed. Other columns than the first ones' are an error."""
    new = [n for n in _names(spark, staging, ".json") if n not in set(_names(spark, processed, ".json"))]
    loaded = {n: _read(spark, f"{staging}/{n}") for n in new}
    if not loaded:
        return []
    want = StructType.fromJson(next(iter(loaded.values()))["schema"])
    fs, target = _fs(spark, final)
    if fs.exists(target) and _names(spark, final, ".parquet"):
        want = spark.read.parquet(final).schema
    for n, sidecar in loaded.items():
        if [(f.name, f.dataType) for f in StructType.fromJson(sidecar["schema"])] != [(f.name, f.dataType) for f in want]:
            raise ValueError(f"{n} has other columns than the table")
    fs.mkdirs(target)
    for n, sidecar in loaded.items():
        run = n.removesuffix(".json")
        for part in sidecar["fragments"]:
            _, source = _fs(spark, f"{staging}/{run}/{part}")
            if fs.exists(source):
                fs.rename(source, _fs(spark, f"{final}/{run}-{part}")[1])
        _written(spark, f"{processed}/{n}", json.dumps(sidecar))
        fs.delete(_fs(spark, f"{staging}/{n}")[1], False)
        fs.delete(_fs(spark, f"{staging}/{run}")[1], True)
    return new
