"""Semantic dedup and matching queries on the embeddings, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import vectors
from skein.operators import semdedup
from skein.plans.tables import table

EPS = [0.3, 0.1, 0.01]


def _middles(spark: SparkSession, d: str) -> DataFrame:
    return semdedup.centroids(table(spark, d, "embeddings"), "label", "embedding")


def _scored(spark: SparkSession, d: str) -> DataFrame:
    rows = semdedup.ranked(table(spark, d, "embeddings"), "vec_id", "label", "embedding", _middles(spark, d))
    return semdedup.max_earlier(rows, "vec_id", "label")


def semdedup_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Each vector's greatest cosine to one farther from its cluster's centroid."""
    return _scored(spark, d).select("vec_id", "label", F.round("cosine_sim_score", 4).alias("score"))


UNIT = """u AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE / greatest(sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE))), 1e-12)) AS v FROM embeddings),
m AS (SELECT label, list(x ORDER BY i) AS c FROM (SELECT label, i, avg(v[i]) AS x FROM u, generate_series(1, 64) AS g(i) GROUP BY label, i) t GROUP BY label),
mu AS (SELECT label, list_transform(c, lambda x: x / greatest(sqrt(list_sum(list_transform(c, lambda y: y * y))), 1e-12)) AS c FROM m)"""
SCORED = f"""{UNIT}, r AS (SELECT vec_id, u.label, v, row_number() OVER (PARTITION BY u.label ORDER BY round(1 - greatest(least(list_dot_product(v, c), 1.0), -1.0), 9) DESC, vec_id) AS k FROM u JOIN mu ON mu.label = u.label),
s AS (SELECT a.vec_id, a.label, coalesce(max(CASE WHEN b.k IS NOT NULL THEN greatest(least(list_dot_product(a.v, b.v), 1.0), -1.0) END), 0.0) AS score FROM r a LEFT JOIN r b ON a.label = b.label AND b.k < a.k GROUP BY ALL)"""
PAIRS_SQL = f"WITH {SCORED} SELECT vec_id, label, round(score, 4) AS score FROM s"


def semdedup_summary(spark: SparkSession, d: str) -> DataFrame:
    """Kept and removed vectors for several thresholds."""
    return semdedup.eps_summary(_scored(spark, d), EPS)


SUMMARY_SQL = f"WITH {SCORED} " + " UNION ALL ".join(f"SELECT '{e}' AS eps, count(*) FILTER (score <= 1 - {e}) AS kept, count(*) FILTER (score > 1 - {e}) AS removed, count(*) AS total FROM s" for e in EPS)


def semdedup_prune(spark: SparkSession, d: str) -> DataFrame:
    """Vectors that stay at a threshold of 0.1."""
    return semdedup.pruned(table(spark, d, "embeddings"), _scored(spark, d), "vec_id", 0.1).select("vec_id", "label")


PRUNE_SQL = f"WITH {SCORED} SELECT vec_id, label FROM s WHERE NOT score >= 1 - 0.1"


def nearest_centroid(spark: SparkSession, d: str) -> DataFrame:
    """The nearest of all clusters' centroids to each vector."""
    made = semdedup.nearest_centroid(table(spark, d, "embeddings"), "vec_id", "embedding", _middles(spark, d), "label")
    return made.select("vec_id", "label", F.round("score", 4).alias("score"))


CENTROID_SQL = f"WITH {UNIT} SELECT vec_id, arg_max(mu.label, list_dot_product(v, c)) AS label, round(max(list_dot_product(v, c)), 4) AS score FROM u, mu GROUP BY vec_id"


def text_match(spark: SparkSession, d: str) -> DataFrame:
    """The three likeliest of ten labels for each vector, by softmax over all ten."""
    rows = table(spark, d, "embeddings")
    texts = rows.filter("vec_id < 10").select(F.col("vec_id").alias("text_id"), "embedding")
    made = semdedup.text_matches(rows, "vec_id", "embedding", texts, "text_id", 3)
    return made.select("vec_id", "text_id", F.round("probability", 4).alias("probability"), "rank")


MATCH_SQL = f"""WITH {UNIT}, z AS (SELECT u.vec_id, t.vec_id AS text_id, 100 * list_dot_product(u.v, t.v) AS z FROM u, u t WHERE t.vec_id < 10),
p AS (SELECT vec_id, text_id, exp(z - max(z) OVER w) / sum(exp(z)) OVER w * exp(max(z) OVER w) AS p, row_number() OVER (PARTITION BY vec_id ORDER BY z DESC, text_id) AS rank FROM z WINDOW w AS (PARTITION BY vec_id))
SELECT vec_id, text_id, round(p, 4) AS probability, rank FROM p WHERE rank <= 3"""


def kmeans_assign(spark: SparkSession, d: str) -> DataFrame:
    """An MLlib k-means with cosine distance, held against exact assignment: rows, rows whose cluster is not the nearest by
    more than rounding, and whether the clusters are tighter than one cluster of all rows."""
    rows = table(spark, d, "embeddings")
    model, features = semdedup.kmeans_fit(rows, "embedding", 8)
    middles = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "k int, centroid array<double>")  # eight
    own = model.transform(features).select("vec_id", F.col("prediction").alias("k"), vectors.unit(F.col("embedding")).alias("u")).join(middles.select("k", vectors.unit(F.col("centroid")).alias("c")), "k")
    own = own.select("vec_id", vectors.dot(F.col("u"), F.col("c")).alias("own"))
    best = semdedup.nearest_centroid(rows, "vec_id", "embedding", middles.select("k", vectors.unit(F.col("centroid")).alias("centroid")), "k").select("vec_id", F.col("score").alias("best"))
    one = semdedup.nearest_centroid(rows, "vec_id", "embedding", semdedup.centroids(rows.withColumn("k", F.lit(0)), "k", "embedding"), "k").select("vec_id", F.col("score").alias("one"))
    return own.join(best, "vec_id").join(one, "vec_id").agg(F.count("*").alias("n_rows"), F.count_if(F.col("best") - F.col("own") > 1e-6).alias("n_wrong"), (F.avg("own") > F.avg("one")).alias("tighter"))


def vector_norms(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.round(F.sqrt(vectors.dot(F.col("embedding"), F.col("embedding"))), 4).alias("norm"))


QUERIES = {f.__name__: f for f in (semdedup_pairs, semdedup_summary, semdedup_prune, nearest_centroid, text_match, kmeans_assign, vector_norms)}
ORACLES = {
    "semdedup_pairs": PAIRS_SQL,
    "semdedup_summary": SUMMARY_SQL,
    "semdedup_prune": PRUNE_SQL,
    "nearest_centroid": CENTROID_SQL,
    "text_match": MATCH_SQL,
    "kmeans_assign": "SELECT count(*) AS n_rows, 0::BIGINT AS n_wrong, true AS tighter FROM embeddings",
    "vector_norms": "SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 4) AS norm FROM embeddings",
}
