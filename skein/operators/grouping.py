"""Order-dependent grouping: greedy packing by bytes, chunks that close on reach, near-equal chunks, part numbers.

Both folds look sequential, but where a group that begins at a row ends follows from sums of sizes alone. So rows lie in
range partitions of (key, order), a key in as many as it needs. Each partition says what its first key's rows would do
for any size that the partition before may hand on: a table of the few rows at which its first group can begin. One pass
over these tables, a row for each partition, settles what is handed on; then every partition numbers its rows by itself.
Give the folds narrow rows (key, order, size) and join what is heavy to the numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.session import checkpointed

#: The rules: a group closes before a row that would pass the target, or after the row that reaches it.
BEFORE, AFTER = "before", "after"


class Fold:
    """Where groups of consecutive rows begin, from sums of their sizes."""

    def __init__(self, sizes: np.ndarray, target: int, rule: str) -> None:
        self.sums = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        self.n, self.target, self.rule = len(sizes), target, rule

    def _passing(self, bound) -> np.ndarray:
        """The first row that a group may not take once the sums reach ``bound``."""
        if self.rule == BEFORE:
            return np.searchsorted(self.sums, bound, side="right") - 1
        return np.searchsorted(self.sums, bound, side="left")

    def first(self, so_far: int) -> int:
        """The first row that begins a group if ``so_far`` is open before row 0; n if none does."""
        return int(np.clip(self._passing(self.target - so_far), 0, self.n))

    def after(self, rows) -> np.ndarray:
        """The row that begins the group after the one that begins at each row; n if none does."""
        return np.clip(self._passing(self.sums[rows] + self.target), np.asarray(rows) + 1, self.n)

    def outcomes(self) -> tuple[np.ndarray, np.ndarray]:
        """For groups that begin at each row: how many there are up to the end, and the size of the last one."""
        ends = np.append(self.after(np.arange(self.n)), self.n)
        count = np.append(np.ones(self.n, np.int64), 0)
        last = np.append(np.where(ends[:-1] == self.n, np.arange(self.n), ends[:-1]), self.n)
        jump = ends
        while (jump < self.n).any():
            count, jump, last = count + count[jump], jump[jump], last[last]
        return count[:-1], self.sums[self.n] - self.sums[last[:-1]]

    def numbers(self, so_far: int | None, number: int) -> np.ndarray:
        """The group of each row: from 0, or after ``number`` with ``so_far`` in it."""
        at, starts = 0 if so_far is None else self.first(so_far), []
        while at < self.n:
            starts.append(at)
            at = int(self.after(at))
        before = np.searchsorted(starts, np.arange(self.n), side="right")
        return before - 1 if so_far is None else before + number


def _segments(table: pa.Table, key: str, size: str) -> tuple[list, list[np.ndarray]]:
    """Keys and sizes of the runs of one key, in order; null sizes count nothing."""
    column = table[key].combine_chunks()
    codes = pc.fill_null(column.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
    cut = np.flatnonzero(np.diff(codes)) + 1
    sizes = pc.fill_null(table[size].combine_chunks().cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
    return [column[int(i)].as_py() for i in [0, *cut]], np.split(sizes, cut)


def _folded(rows: DataFrame, key: str, order: list[str], size: str, target: int, rule: str) -> DataFrame:
    """``rows`` with a ``group_no`` from 0 within each key."""
    kinds = dict(rows.dtypes)
    laid = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).withColumn("__p", F.spark_partition_id())
    laid = checkpointed(laid)  # a row's partition is fixed from here on

    def heads(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        keys, sizes = _segments(table, key, size)
        fold = Fold(sizes[0], target, rule)
        count, out = fold.outcomes()
        n = min(fold.first(0) + 1, fold.n)
        end = Fold(sizes[-1], target, rule).outcomes() if len(keys) > 1 else (count, out)
        kind = table[key].type
        row = [pa.array([table["__p"][0].as_py()], pa.int32()), pa.array([keys[0]], kind), pa.array([fold.sums[: n + 1].tolist()]), pa.array([count[:n].tolist()]), pa.array([out[:n].tolist()])]
        row += [pa.array([int(fold.sums[-1])]), pa.array([fold.n]), pa.array([len(keys) > 1]), pa.array([keys[-1]], kind), pa.array([int(end[0][0])]), pa.array([int(end[1][0])])]
        yield pa.RecordBatch.from_arrays(row, names=names)

    names = ["__p", "first", "sums", "counts", "outs", "total", "n", "more", "last", "last_count", "last_out"]
    said = laid.select("__p", key, size).mapInArrow(heads, f"__p int, first {kinds[key]}, sums array<long>, counts array<long>, outs array<long>, total long, n long, more boolean, last {kinds[key]}, last_count long, last_out long")

    def handed(batches):
        open_, at, number, so_far = False, None, 0, 0
        for b in batches:
            given = []
            for r in b.to_pylist():
                if open_ and r["first"] == at:
                    given.append((r["__p"], so_far, number))
                    part = Fold(np.diff(r["sums"]), target, rule)
                    begins = part.first(so_far)
                    if begins < len(r["counts"]):
                        number, so_far = number + r["counts"][begins], r["outs"][begins]
                    else:
                        so_far += r["total"]
                else:
                    given.append((r["__p"], None, 0))
                    open_, at, number, so_far = True, r["first"], r["counts"][0] - 1, r["outs"][0]
                if r["more"]:
                    at, number, so_far = r["last"], r["last_count"] - 1, r["last_out"]
            p, s, g = zip(*given) if given else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(s, pa.int64()), pa.array(g, pa.int64())], names=["__p", "__so_far", "__number"])

    chained = said.repartition(1).sortWithinPartitions("__p").mapInArrow(handed, "__p int, __so_far long, __number long")  # a row for each partition
    schema = T.StructType([*rows.schema.fields, T.StructField("group_no", T.LongType())])

    def numbered(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        _, sizes = _segments(table, key, size)
        so_far, number = table["__so_far"][0].as_py(), table["__number"][0].as_py()
        parts = [Fold(part, target, rule).numbers(so_far if i == 0 else None, number) for i, part in enumerate(sizes)]
        out = table.drop_columns(["__p", "__so_far", "__number"]).append_column("group_no", pa.array(np.concatenate(parts).astype(np.int64)))
        yield from out.to_batches(max_chunksize=10_000)

    whole = laid.join(F.broadcast(checkpointed(chained)), "__p")  # as many rows as partitions; the join keeps a partition's order
    return whole.select(*rows.columns, "__p", "__so_far", "__number").mapInArrow(numbered, schema)


def packed(rows: DataFrame, key: str, order: list[str], size: str, target: int) -> DataFrame:
    """Greedy packing: a row that would exceed ``target`` starts a new group; the first of a group always fits."""
    return _folded(rows, key, order, size, target, BEFORE)


def closed_on_reach(rows: DataFrame, key: str, order: list[str], size: str, target: int) -> DataFrame:
    """Chunks that close once their size reaches ``target``, the row that reaches it included."""
    return _folded(rows, key, order, size, target, AFTER)


def drop_small_last(grouped: DataFrame, key: str, min_rows: int) -> DataFrame:
    """Without the last group of each key if it has fewer rows than that; other small groups stay."""
    sizes = grouped.groupBy(key, "group_no").agg(F.count("*").alias("n"))
    last = sizes.groupBy(key).agg(F.max_by("n", "group_no").alias("n"), F.max("group_no").alias("group_no")).filter(F.col("n") < min_rows)
    return grouped.join(last.select(key, "group_no"), [key, "group_no"], "left_anti")


def near_equal(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """``n`` chunks in order, the first ones longer by one; fewer rows than that are one chunk each.

    A global order needs one row number for each row. Range partitions are numbered by their sizes, so no task gets
    all rows.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id())
    ranged = checkpointed(ranged)  # both numbers are fixed from here on
    sizes = ranged.groupBy("__p").agg(F.count("*").alias("__n"), F.min("__i").alias("__first"))
    before = W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)  # one row for each partition
    starts = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).withColumn("__all", F.sum("__n").over(W.partitionBy()))
    at = F.col("__i") - F.col("__first") + F.col("__before")
    d, r = F.floor(F.col("__all") / n), F.col("__all") % n
    chunk = F.when(F.col("__all") <= n, at).when(at < r * (d + 1), F.floor(at / (d + 1))).otherwise(r + F.floor((at - r * (d + 1)) / d))
    return ranged.join(F.broadcast(starts), "__p").withColumn("chunk", chunk.cast("long")).drop("__p", "__i", "__n", "__first", "__before", "__all")  # as many rows as partitions


def numbered_parts(groups: DataFrame, key: str, existing: DataFrame, max_tars: int) -> DataFrame:
    """``groups`` (key, group_no from 0) with part and tar numbers; parts go on after the greatest existing one.

    ``existing``: (key, part).
    """
    last = existing.groupBy(key).agg(F.max("part").alias("__last"))
    out = groups.join(last, key, "left")
    return out.withColumn("part", (F.coalesce("__last", F.lit(-1)) + 1 + F.floor(F.col("group_no") / max_tars)).cast("long")).withColumn("tar", (F.col("group_no") % max_tars).cast("long")).drop("__last")
