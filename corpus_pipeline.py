"""The corpus pipeline: documents in, packed clean documents out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.llm import decontaminate, minhash, packing, quality, secret_scan
from footfall.llm.tables import count_stored, delete, drop_stored, shared_folder, table


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.keep_one(docs)


def remove_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark text go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secret_scan.redact(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their length bucket, batch and slot."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", remove_benchmark_text),
    ("secret scans", redact_secrets),
    ("packing", pack_batches),
]

#: Training and MinHash are beyond SQL; tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are a written table before the next reads them, and then what
    the stage stored on the way and its predecessor's rows go."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        before = count_stored()
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        drop_stored(spark, before)
        if k:
            delete(spark, f"{folder}/{k - 1}")
    return docs
