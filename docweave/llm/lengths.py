"""Token counts from an exact histogram of encoded lengths.

Documents are aggregated by their encoded length, first within each batch, so
the histogram has a row per distinct length and no row per document is moved.
Sums over it from either end then answer, for every context limit, how many
documents are longer, how many tokens are kept when longer ones are cut off, and
which quantiles lie at that length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from docweave.llm.tokens import encoded
from docweave.session import cut_lineage

BLOCK = 1024


def length_histogram(docs: DataFrame, text_column: str = "text", end_id: int | None = 1) -> DataFrame:
    """(length, n_docs): exact numbers of documents by encoded length, the end id counted."""

    def count(batches):
        for batch, _, upto in encoded(batches, end_id=end_id):
            length, n = np.unique(np.diff(upto, prepend=0), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(length, pa.int64()), pa.array(n, pa.int64())], ["length", "n_docs"])

    one = docs.select(F.col(f"`{text_column}`").alias("text")).mapInArrow(count, "length long, n_docs long")
    return one.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def with_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with sums up to and beyond each length.

    Sums are taken inside blocks of lengths and added to sums over whole blocks,
    so no task gets all lengths. Adds docs_upto, tokens_upto (documents no longer
    than this), docs_over, tokens_over (longer ones), n_all, tokens_all.
    """
    blocks = histogram.withColumn("_block", F.floor(F.col("length") / BLOCK)).withColumn(
        "_tokens", F.col("length") * F.col("n_docs")
    )
    whole = blocks.groupBy("_block").agg(F.sum("n_docs").alias("_d"), F.sum("_tokens").alias("_t"))
    before, over_all = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1), W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    zero = lambda c: F.coalesce(c, F.lit(0))
    whole = whole.select(
        "_block",
        zero(F.sum("_d").over(before)).alias("_db"),
        zero(F.sum("_t").over(before)).alias("_tb"),
        F.sum("_d").over(over_all).alias("n_all"),
        F.sum("_t").over(over_all).alias("tokens_all"),
    )
    inside = W.partitionBy("_block").orderBy("length").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        blocks.withColumn("_di", F.sum("n_docs").over(inside))
        .withColumn("_ti", F.sum("_tokens").over(inside))
        .join(whole, "_block")
        .select(
            "length",
            "n_docs",
            (F.col("_di") + F.col("_db")).alias("docs_upto"),
            (F.col("_ti") + F.col("_tb")).alias("tokens_upto"),
            (F.col("n_all") - F.col("_di") - F.col("_db")).alias("docs_over"),
            (F.col("tokens_all") - F.col("_ti") - F.col("_tb")).alias("tokens_over"),
            "n_all",
            "tokens_all",
        )
    )


def answers(sums: DataFrame) -> DataFrame:
    """Per length taken as context limit: totals, truncated totals and the quantiles there.

    ``kept_tokens``: all tokens when longer documents are cut to the limit;
    ``quantile_from`` to ``quantile_to``: the quantiles whose length this is.
    Between two lengths of the histogram a limit L keeps tokens_upto of the lower
    one plus L times docs_over.
    """
    share = lambda n: n / F.col("n_all")
    return sums.select(
        F.col("length").alias("context_limit"),
        "n_docs",
        "docs_upto",
        "docs_over",
        "tokens_upto",
        "tokens_over",
        (F.col("tokens_upto") + F.col("length") * F.col("docs_over")).alias("kept_tokens"),
        (F.col("tokens_over") - F.col("length") * F.col("docs_over")).alias("cut_tokens"),
        "tokens_all",
        share(F.col("docs_upto") - F.col("n_docs")).alias("quantile_from"),
        share(F.col("docs_upto")).alias("quantile_to"),
    )


def kept_at(sums: DataFrame, limit: int) -> DataFrame:
    """One row for any limit: docs_over, kept_tokens."""
    upto = F.col("length") <= F.lit(limit)
    return sums.agg(
        F.coalesce(F.sum(F.when(~upto, F.col("n_docs"))), F.lit(0)).alias("docs_over"),
        F.coalesce(
            F.sum(F.when(upto, F.col("length")).otherwise(F.lit(limit)) * F.col("n_docs")), F.lit(0)
        ).alias("kept_tokens"),
    )


def token_counts(docs: DataFrame) -> DataFrame:
    """Token counts of ``docs`` for every context limit that is a document's length.

    Null and empty texts have one token, the end id. Repeated rows count as often
    as they occur, ids and other columns are ignored, an empty table gives no
    rows.
    """
    # the sums read the histogram twice: it is stored, so that texts are encoded once
    return answers(with_sums(cut_lineage(length_histogram(docs), "lengths")))
