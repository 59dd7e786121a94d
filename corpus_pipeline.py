"""A corpus pipeline of five operators: quality, near-duplicates, shared passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the driver writes it as Parquet and the next stage reads
it back as ``docs``. All stages but the last return the columns of ``documents``; texts that a stage changes get their
new ``n_chars``. The stages decide by hashes, counts and learned votes that SQL cannot express, so there is no SQL; the
tests compare each stage with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import chunk_dedup, minhash, packing, quality_knn, secret_scan
from skein.session import delete_folder, shared_folder

ORACLE_SQL = None


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents whose quality score is below the threshold go."""
    everything = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_knn.keep_good(docs, quality_knn.learned(spark, everything, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: one document of each near-duplicate class stays, that of the least id."""
    return minhash.keep_one(docs)


def cut_shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: passages that a document of lesser id has too are cut out; documents that this leaves empty go."""
    had_none = F.coalesce(F.length("text") == 0, F.lit(True))  # a null or empty text lost nothing
    cut = chunk_dedup.dedup(docs.withColumn("__had_none", had_none), stats=False)
    changed = cut.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return changed.filter(F.col("__had_none") | (F.length("text") > 0)).select(docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: secrets, encoded ones too, are replaced in the texts."""
    found = secret_scan.scan(docs)
    return found.withColumn("text", F.col("redacted")).withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: the documents' pieces packed into sequences."""
    import public_tokenizers as tokens

    return packing.packed_documents(docs, tokens.path("byte_bpe_50k.tiktoken"), tokens.PATTERN, tokens.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("shared_passages", cut_shared_passages),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written as Parquet and read again.

    A stage's rows go when the next one's are written, the last one's when the session ends.
    """
    folder = shared_folder(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{k}-{name}")
        if before is not None:
            delete_folder(spark, before)
        before = f"{folder}/{k}-{name}"
        docs = spark.read.parquet(before)
    return docs
