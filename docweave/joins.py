"""Numbering that stays even when one key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window as W


def number_within(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """1-based position of each row within ``keys`` in input order.

    Only counts per (key, partition) are shuffled, so a key spread over many
    partitions is never gathered in one task. ``df`` must be read straight from
    files: a re-evaluated scan yields the same partitions.
    """
    tagged = df.withColumn("_at", F.monotonically_increasing_id()).withColumn(
        "_part", F.shiftright("_at", 33)
    )
    spans = tagged.groupBy(*keys, "_part").agg(
        F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_n")
    )
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = spans.select(
        *keys, "_part", "_low", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    joined = tagged.join(offsets, [*keys, "_part"])
    return joined.withColumn(name, F.col("_at") - F.col("_low") + F.col("_before") + 1).drop(
        "_at", "_part", "_low", "_before"
    )
