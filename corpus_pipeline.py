"""The corpus pipeline: toxicity, near copies, repeated passages, leaked test items, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docweave.llm import anchors, leaks, packing, parity, toxicity
from docweave.llm.tables import small_batches
from docweave.session import cut_lineage


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine rejects go."""
    small_batches(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, Jaccard 0.8)."""
    small_batches(spark)
    return parity.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document has too are cut."""
    small_batches(spark)
    return anchors.cut_repeats(docs)


def test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat a benchmark item go."""
    small_batches(spark)
    return leaks.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left in sequences of at most 4096 tokens."""
    small_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("test_items", test_items),
    ("packing", packed),
]

# Learned scores, sketches and tokenizers are beyond SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, each written to the shared folder and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
