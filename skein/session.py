"""Session helpers shared by the engine: a tuned local session and shipping of this package to the workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings that the plans rely on; a cluster's own defaults win for everything else.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(app: str = "skein", cores: int = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session on this machine, as the tests and the benchmark use it."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = DEFAULTS | {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once for each context, so that functions can be pickled by reference."""
    context = spark.sparkContext
    if getattr(context, "_skein_shipped", False):
        return
    root = Path(__file__).resolve().parent
    fd, name = tempfile.mkstemp(prefix="skein-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent).as_posix())
    context.addPyFile(name)
    context._skein_shipped = True


def _base(spark: SparkSession) -> str:
    """The folder that all executors share: one given to ``setCheckpointDir``, else that of ``spark.checkpoint.dir``.

    Only on a local master, where both may be unset (tests), a folder of this machine is chosen. Spark makes a folder of
    its own in the one that the setting names; that one goes when the session's JVM ends.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            named = tempfile.mkdtemp(prefix="skein-")
            _delete_at_exit(spark, named)
        context.setCheckpointDir(named)
    base = context.getCheckpointDir()
    if named is not None:
        path, fs = _path(spark, named)
        if base.startswith(fs.makeQualified(path).toString()):
            _delete_at_exit(spark, base)
    return base


def _path(spark: SparkSession, folder: str):
    """A Hadoop path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete_at_exit(spark: SparkSession, folder: str) -> None:
    """Lets a folder go with the JVM; it is made for that, as Hadoop takes note of none that is not there."""
    path, fs = _path(spark, folder)
    fs.mkdirs(path)
    fs.deleteOnExit(path)


def shared_folder(spark: SparkSession, prefix: str) -> str:
    """The name of a folder beside the checkpoints that is not there yet; it goes when the session's JVM ends."""
    folder = f"{_base(spark).rstrip('/')}/{prefix}-{uuid.uuid4()}"
    _delete_at_exit(spark, folder)
    return f"{folder}/data"


def delete_folder(spark: SparkSession, folder: str) -> None:
    path, fs = _path(spark, folder)
    fs.delete(path, True)


#: Spark's own setting by which an execution's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder; the shuffle files that made them go at once."""
    spark = df.sparkSession
    _base(spark)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint()  # a new execution, which reads the setting
    finally:
        spark.conf.set(CLEANUP, before)
