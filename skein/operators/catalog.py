"""Catalog queries over sessions, clips and captions: what is still to do, ordered arrays, completeness, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def not_done(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``wanted`` without a row of equal keys in ``done`` (NOT EXISTS)."""
    return wanted.join(done.select(*keys), keys, "left_anti")


def finished_sessions(markers: DataFrame, chunks: DataFrame, session: str, expected: str, index: str) -> DataFrame:
    """Sessions whose marker exists and whose distinct chunks are as many as the marker says."""
    seen = chunks.groupBy(session).agg(F.count_distinct(index).alias("__n"))
    return markers.join(seen, session).filter(F.col("__n") == F.col(expected)).select(session)


def resumed(inputs: DataFrame, finished: DataFrame, key: str, limit: int = 0) -> DataFrame:
    """Inputs that are not finished, by key; the limit counts after finished work is left out."""
    left = inputs.join(finished.select(key), key, "left_anti").orderBy(key)
    return left.limit(limit) if limit else left


def ordered_arrays(rows: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """One row for each key with an array of each column, all in the order of ``order``; one sort for all arrays."""
    packed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, *columns))).alias("__a"))
    names = [order, *columns]
    return packed.select(*keys, *(F.col("__a")[n].alias(f"{n}s") for n in names))


def complete(count: Column, arrays: list[Column], cameras: Column, required: list, per_clip: Column | None = None, windows: int = 2) -> Column:
    """Whether all arrays have the camera count, every inner list has ``windows`` items and no required camera lacks."""
    fits = count == F.size(cameras)
    for a in arrays:
        fits = fits & (F.size(a) == count)
    if per_clip is not None:
        fits = fits & F.forall(per_clip, lambda x: F.size(x) == windows)
    return fits & (F.size(F.array_except(F.array(*(F.lit(r) for r in required)), cameras)) == 0)


def looked_up(groups: DataFrame, keys: list[str], ids: str, table: DataFrame, id_: str, value: str, version: str | None = None) -> DataFrame:
    """``keys`` and ``values``: the value of each id of an array, in its place; null where the table has none.

    Of several rows of an id the one of the greatest ``version`` counts.
    """
    last = table.groupBy(id_).agg((F.max_by(value, version) if version else F.max(value)).alias("__v"))
    each = groups.select(*keys, F.posexplode_outer(ids).alias("__i", id_))
    found = each.join(last, id_, "left").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__i", "__v"))).alias("__a"))
    return found.select(*keys, F.col("__a.__v").alias("values"))


def primary_first(paths: DataFrame, group: str, path: str, keyword: str, strict: bool = True) -> DataFrame:
    """``paths`` with ``camera_rank``: the one path of a group with the keyword is 0, the others follow sorted.

    ``strict``: a group with none or several such paths is an error. A group is a session: as many paths as cameras.
    """
    has = F.contains(F.col(path), F.lit(keyword))
    sorted_ = F.array_sort(F.collect_list(F.struct((~has).alias("other"), F.col(path).alias("p"))))
    grouped = paths.groupBy(group).agg(sorted_.alias("all"), F.count_if(has).alias("n"))
    if strict:
        grouped = grouped.withColumn("all", F.when(F.col("n") == 1, F.col("all")).otherwise(F.raise_error(F.concat(F.lit("primary paths of "), F.col(group).cast("string"), F.lit(": "), F.col("n").cast("string")))))
    return grouped.select(group, F.posexplode("all").alias("camera_rank", "x")).select(group, F.col("x.p").alias(path), F.col("camera_rank").cast("long").alias("camera_rank"))


def misaligned(clips: DataFrame, session: str, index: str, camera: str, span: list[str]) -> DataFrame:
    """(session, index) of clips whose spans differ between cameras, or that a camera lacks."""
    cameras = clips.groupBy(session).agg(F.count_distinct(camera).alias("__all"))
    each = clips.groupBy(session, index).agg(F.count_distinct(F.struct(*span)).alias("__spans"), F.count_distinct(camera).alias("__own"))
    return each.join(cameras, session).filter((F.col("__spans") > 1) | (F.col("__own") < F.col("__all"))).select(session, index)


def assert_unique(df: DataFrame, *keys: str) -> None:
    """Error if rows share a key: the catalog's stand-in for a unique constraint."""
    twice = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{keys} is not unique: {twice[0]}")


def schema_changes(have: dict[str, str], want: dict[str, str]) -> list[tuple[str, str, str]]:
    """(action, column, type) that turn one table schema into another."""
    return [("add", c, t) for c, t in want.items() if c not in have] + [("drop", c, have[c]) for c in have if c not in want] + [("alter", c, want[c]) for c in want if c in have and have[c] != want[c]]


def evolved(rows: DataFrame, want: dict[str, str]) -> DataFrame:
    """``rows`` under another schema: columns dropped, added as nulls and cast; a value that does not fit is an error."""
    have = dict(rows.dtypes)
    return rows.select(*((F.col(c).cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in want.items()))


def described(spark: SparkSession, database: str | None = None) -> DataFrame:
    """(table, column, type) of all tables of a database."""
    rows = [(t.name, c.name, c.dataType) for t in spark.catalog.listTables(database) for c in spark.catalog.listColumns(t.name)]
    return spark.createDataFrame(rows, "table string, column string, type string")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows that name a parent that is not there: a foreign key's violations; null keys name none."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(key).distinct(), key, "left_anti")


def deleted(tables: dict[str, DataFrame], links: list[tuple[str, str, str]], table: str, key: str, gone: DataFrame) -> dict[str, DataFrame]:
    """The tables without the rows of ``table`` that ``gone`` (key) names, and without what refers to those.

    ``links``: (child, parent, key), of each parent its own key in the child; parents before children.
    """
    left = dict(tables)
    lost = {table: left[table].join(gone.select(key), key, "left_semi")}
    left[table] = left[table].join(gone.select(key), key, "left_anti")
    for child, parent, via in links:
        if parent in lost:
            lost[child] = left[child].join(lost[parent].select(via).distinct(), via, "left_semi")
            left[child] = left[child].join(lost[parent].select(via).distinct(), via, "left_anti")
    return left
