"""Row keys and joins that the operators share."""

from __future__ import annotations

from math import log

from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.session import remove_path

# Rows without an id come after all others.
NO_ID = (1 << 63) - 1


def keyed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(_id, _key, text): the id (null: last) and a hash of id and text.

    Repeated rows share a key and so get one result each; rows that share an id
    but not the text are told apart.
    """
    text = F.col(f"`{text_column}`")
    return docs.select(
        F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64(F.col(f"`{id_column}`"), text).alias("_key"),
        text.alias("text"),
    )


def shielded(docs: DataFrame):
    """``docs`` with _id, _key and text, own columns under names that clash with nothing, and the way back."""
    own = [F.col(f"`{c}`").alias(f"own{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(
        *own,
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64("doc_id", "text").alias("_key"),
        F.col("text").alias("text"),
    )

    def back(df: DataFrame, **changed) -> DataFrame:
        """The columns of ``docs``; ``changed``: other expressions for some of them."""
        return df.select(*(changed.get(c, F.col(f"own{i}")).alias(c) for i, c in enumerate(docs.columns)))

    return rows, back


def real_id(column: str = "_id"):
    """The id as it was."""
    return F.when(F.col(column) != F.lit(NO_ID), F.col(column))


def held_out(column: str = "doc_id"):
    """Rows set aside from learning: crc32 of the id as text divisible by 5; rows without an id too."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(True))


def _known(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, _label) of the documents that are labelled 0 or 1 and not held out."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("_label")).filter("doc_id is not null")
    known = known.filter(F.col("_label").isin(0, 1) & ~held_out()).dropDuplicates(["doc_id"])
    return known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(text, label) of at most ``most`` documents of each label 0 and 1 that are not held out.

    The documents with the least hash of their id are taken, so the choice
    neither depends on partitions nor on the order of rows.
    """
    known = _known(docs, labels, label)
    rank = F.xxhash64(F.col("doc_id").cast("string"))
    parts = [known.filter(F.col("_label") == v).orderBy(rank, "doc_id").limit(most) for v in (0, 1)]
    return docs.select("doc_id", "text").join(parts[0].union(parts[1]), "doc_id").select("text", F.col("_label").alias("label"))


def prior_shift(docs: DataFrame, labels: DataFrame, label: str, most: int) -> float:
    """What the log odds of label 1 differ by between all labelled documents and ``labelled_sample``.

    Added to a model of the sample, it makes a score of one half mean the same
    whether the bound was reached or not. 0 where a label has no documents.
    """
    n = {r["_label"]: r["count"] for r in _known(docs, labels, label).groupBy("_label").count().collect()}
    if len(n) < 2:
        return 0.0
    return log(n[1] / n[0]) - log(min(n[1], most) / min(n[0], most))


def drop_table(table: DataFrame) -> None:
    """Delete the files of a stored intermediate table that nothing reads any more."""
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        remove_path(table.sparkSession, folder)


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20) -> None:
    """Fewer rows and bytes at once between Spark and Python: long texts and packed keys make large batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def fill(df: DataFrame, least: int = 1) -> int:
    """Partitions for a shuffle that every core should share."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
