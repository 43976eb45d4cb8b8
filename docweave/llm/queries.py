"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docweave.llm import anchors, huffman, language, leaks, lengths, licenses, packing, parity, pivots, quality, spelling, suffixes, toxicity
from docweave.llm.tables import small_batches

QUERIES = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{d}/{name}.parquet")


@query
def op4_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return anchors.substring_digest(table(spark, d, "documents").select("doc_id", "text"))


@query
def op5_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents").select("doc_id", "text"))


@query
def op7_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return lengths.token_counts(table(spark, d, "documents").select("text"))


@query
def op9_token_files(spark: SparkSession, d: str) -> DataFrame:
    return huffman.token_files(table(spark, d, "documents").select("doc_id", "text"))


@query
def op10_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return parity.near_duplicates(table(spark, d, "documents").select("doc_id", "text"))


@query
def op1_language_profiles(spark: SparkSession, d: str) -> DataFrame:
    return language.identify(table(spark, d, "documents").select("doc_id", "text", "lang"))


@query
def op6_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.toxicity(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "labels"))


@query
def op2_quality_lines(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "labels"))


@query
def op3_decontamination(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return leaks.contaminated(docs, table(spark, d, "benchmark"))


@query
def op8_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return suffixes.repeated_strings(table(spark, d, "documents").select("doc_id", "text"))


@query
def op12_license_scans(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, d, "documents").select("doc_id", "text"))


@query
def op13_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, d, "documents").select("doc_id", "text"))


SQL["op12_license_scans"] = licenses.oracle_sql()
SQL["op13_spelling_variants"] = spelling.oracle_sql()


@query
def op11_vector_codes(spark: SparkSession, d: str) -> DataFrame:
    return pivots.vector_codes(table(spark, d, "embeddings").select("vec_id", "embedding", "label"))


SQL["op11_vector_codes"] = pivots.oracle_sql()
