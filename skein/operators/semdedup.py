"""Semantic dedup: clusters of embeddings, distance ranks, and each row's greatest similarity to an earlier row.

The comparison inside a cluster is quadratic by nature. It runs as tiles: a cluster's ranked rows are cut into blocks,
each pair of blocks is a task that multiplies matrices of ``STEP`` rows at a time, and only the best neighbour of each row
leaves it. So a large cluster is many tasks of bounded size, and no pairs are emitted; a row goes to as many tasks as its
cluster has blocks, so blocks are as large as a task can hold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skein.functions.vectors import clipped_cosine, dot, let, unit
from skein.session import checkpointed

#: Rows of a tile's side, and of the part of it that is multiplied at once.
TILE = 8192
STEP = 1024


def centroids(rows: DataFrame, cluster: str, vector: str) -> DataFrame:
    """(cluster, centroid) as the unit vector of the mean of each cluster's unit vectors; one vector a task and cluster is shuffled."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    units = rows.select(cluster, array_to_vector(unit(F.col(vector))).alias("__u"))
    means = units.groupBy(cluster).agg(Summarizer.mean(F.col("__u")).alias("__c"))
    return means.select(cluster, unit(vector_to_array("__c")).alias("centroid"))


def ranked(rows: DataFrame, key: str, cluster: str, vector: str, middles: DataFrame, digits: int = 9) -> DataFrame:
    """key, cluster, unit vector ``u``, distance to the centroid and rank, farthest first, ties by key.

    Distances are rounded to ``digits``, so that equal vectors tie whatever the order of the sums behind the centroid.

    ``middles`` are few (a row for each cluster) and small; Spark broadcasts them by their size. A cluster is ranked by
    range partitions of (cluster, -distance, key), so a large cluster is not one task.
    """
    near = rows.join(middles, cluster).select(key, cluster, F.round(1 - clipped_cosine(unit(F.col(vector)), F.col("centroid")), digits).alias("distance"))
    order = [F.col(cluster), F.col("distance").desc(), F.col(key)]
    laid = near.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id())
    laid = checkpointed(laid)  # both numbers are fixed from here on
    sizes = laid.groupBy("__p", cluster).agg(F.count("*").alias("__n"), F.min("__i").alias("__first"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(W.partitionBy(cluster).orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    joined = laid.join(before.drop("__n"), ["__p", cluster])
    numbered = joined.select(key, "distance", (F.col("__i") - F.col("__first") + F.col("__before") + 1).cast("long").alias("rank"))
    return rows.select(key, cluster, unit(F.col(vector)).alias("u")).join(numbered, key)


def max_earlier(rows: DataFrame, key: str, cluster: str) -> DataFrame:
    """key, max_id and cosine_sim_score of each row of :func:`ranked`: its nearest earlier row of the same cluster.

    The first row of a cluster points at itself with score 0. Equal scores take the earlier row.
    """
    kind = dict(rows.dtypes)
    tiled = rows.withColumn("tile", F.floor((F.col("rank") - 1) / TILE).cast("int"))
    last = tiled.groupBy(cluster).agg(F.max("tile").alias("last"))
    both = tiled.join(last, cluster)
    # A row is on the left of its own tile row and on the right of all later ones.
    sides = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("tile")), lambda j: F.struct(F.col("tile").alias("i"), j.alias("j"), F.lit(True).alias("left"))),
        F.transform(F.sequence(F.col("tile"), F.col("last")), lambda i: F.struct(i.alias("i"), F.col("tile").alias("j"), F.lit(False).alias("left"))),
    )
    spread = both.withColumn("s", F.explode(sides)).select(cluster, "s.i", "s.j", "s.left", key, "rank", "u")
    schema = f"{key} {kind[key]}, max_id {kind[key]}, score double, rank long"

    def tile(_, t: pa.Table) -> pa.Table:
        left = t.filter(t["left"])
        right = t.filter(pa.compute.invert(t["left"])).sort_by("rank")
        a, b = (np.stack(x["u"].combine_chunks().to_numpy(zero_copy_only=False)) if len(x) else np.zeros((0, 0)) for x in (left, right))
        ra, rb = left["rank"].to_numpy(), right["rank"].to_numpy()
        best, top = np.full(len(a), -1), np.full(len(a), -2.0)
        for x in range(0, len(a), STEP):
            for y in range(0, len(b), STEP):
                score = np.where(rb[None, y : y + STEP] < ra[x : x + STEP, None], np.clip(a[x : x + STEP] @ b[y : y + STEP].T, -1, 1), -2.0)
                at = score.argmax(1)  # of equal ones the earliest, for the right side is in order of rank
                high = score[np.arange(len(score)), at]
                better = high > top[x : x + STEP]
                best[x : x + STEP][better], top[x : x + STEP][better] = at[better] + y, high[better]
        rows_ = np.flatnonzero(best >= 0)
        return pa.table({key: left[key].take(rows_), "max_id": right[key].take(best[rows_]), "score": top[rows_], "rank": rb[best[rows_]]})

    found = spread.groupBy(cluster, "i", "j").applyInArrow(lambda k, t: tile(k, t), schema)
    best = found.groupBy(key).agg(F.max_by(F.struct("max_id", "score"), F.struct("score", (-F.col("rank")).alias("r"))).alias("b")).select(key, "b.*")
    return rows.select(key, cluster, "rank", "distance").join(best, key, "left").select(key, cluster, "rank", "distance", F.coalesce("max_id", key).alias("max_id"), F.coalesce("score", F.lit(0.0)).alias("cosine_sim_score"))


def eps_summary(scored: DataFrame, epsilons: list[float]) -> DataFrame:
    """kept, removed and total for each epsilon; kept means a score of at most 1 - eps."""
    row = scored.agg(F.count("*").alias("total"), *(F.count_if(F.col("cosine_sim_score") <= 1 - e).alias(f"k{i}") for i, e in enumerate(epsilons)))
    listed = F.array(*(F.struct(F.lit(str(e)).alias("eps"), F.col(f"k{i}").alias("kept")) for i, e in enumerate(epsilons)))
    return row.select("total", F.inline(listed)).select("eps", "kept", (F.col("total") - F.col("kept")).alias("removed"), "total")


def pruned(rows: DataFrame, scored: DataFrame, key: str, eps: float) -> DataFrame:
    """``rows`` without those whose score is 1 - eps or more."""
    return rows.join(scored.filter(F.col("cosine_sim_score") >= 1 - eps).select(key), key, "left_anti")


def nearest_centroid(rows: DataFrame, key: str, vector: str, middles: DataFrame, cluster: str) -> DataFrame:
    """key, nearest cluster and its cosine; ties take the lesser cluster.

    All centroids are one array, a scalar subquery that is computed once: there are as many as clusters were asked for,
    which the caller bounds, and no row is multiplied.
    """
    listed = middles.groupBy().agg(F.array_sort(F.collect_list(F.struct(F.col(cluster).alias("k"), F.col("centroid").alias("c")))).alias("all"))
    scored = rows.select(key, vector, listed.scalar().alias("__all")).select(key, let(unit(F.col(vector)), lambda u: F.transform("__all", lambda m: F.struct(dot(u, m["c"]).alias("score"), (-m["k"]).alias("minus")))).alias("s"))
    return scored.select(key, F.array_max("s").alias("b")).select(key, (-F.col("b.minus")).alias(cluster), F.col("b.score").alias("score"))


def kmeans_fit(rows: DataFrame, vector: str, k: int, seed: int = 1, rounds: int = 20):
    """An MLlib k-means model with cosine distance."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    features = rows.select("*", array_to_vector(vector).alias("features"))
    return KMeans(k=k, seed=seed, maxIter=rounds, distanceMeasure="cosine").fit(features), features


def text_matches(clips: DataFrame, key: str, vector: str, texts: DataFrame, label: str, top: int) -> DataFrame:
    """key, label, probability and rank of the ``top`` labels: softmax of 100 times the dot product over all labels.

    The label set is a short list that is given: one array, a scalar subquery that is computed once.
    """
    listed = texts.groupBy().agg(F.array_sort(F.collect_list(F.struct(F.col(label).alias("k"), unit(F.col(vector)).alias("t")))).alias("all"))
    made = clips.select(key, vector, listed.scalar().alias("__all")).select(key, let(unit(F.col(vector)), lambda u: F.transform("__all", lambda m: F.struct((100 * dot(u, m["t"])).alias("z"), (-m["k"]).alias("minus")))).alias("s"))
    z = made.select(key, F.reverse(F.array_sort("s")).alias("s"))
    total = F.aggregate("s", F.lit(0.0), lambda a, x: a + F.exp(x["z"] - F.col("s")[0]["z"]))
    out = z.withColumn("total", total).select(key, F.posexplode(F.slice("s", 1, top)).alias("i", "x"), "total", F.col("s")[0]["z"].alias("top"))
    return out.select(key, (-F.col("x.minus")).alias(label), (F.exp(F.col("x.z") - F.col("top")) / F.col("total")).alias("probability"), (F.col("i") + 1).cast("long").alias("rank"))
