"""SQLite tables as a Spark data source: partitions are ranges of row ids, columns are typed by the given schema."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


class SqliteSource(DataSource):
    """``spark.read.format("skein_sqlite").schema(...).option("path", file).option("table", name)``."""

    @classmethod
    def name(cls) -> str:
        return "skein_sqlite"

    def schema(self) -> str:
        raise ValueError("give the table's schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return SqliteReader(schema, self.options)


class Rows(InputPartition):
    def __init__(self, lo: int, hi: int) -> None:
        self.lo, self.hi = lo, hi


class SqliteReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.columns = ", ".join('"' + n.replace('"', '""') + '"' for n in schema.names)
        self.path, self.table = options["path"], '"' + options["table"].replace('"', '""') + '"'
        self.parts = int(options.get("partitions", "8"))

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as con:
            lo, hi = con.execute(f"SELECT coalesce(min(rowid), 0), coalesce(max(rowid), -1) FROM {self.table}").fetchone()
        step = max(1, -(-(hi - lo + 1) // self.parts))
        return [Rows(a, min(a + step, hi + 1)) for a in range(lo, hi + 1, step)] or [Rows(0, 0)]

    def read(self, partition: Rows) -> Iterator[tuple]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as con:
            yield from con.execute(f"SELECT {self.columns} FROM {self.table} WHERE rowid >= ? AND rowid < ?", (partition.lo, partition.hi))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SqliteSource)
