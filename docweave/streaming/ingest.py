"""Folder ingest as a stream: each new file becomes documents exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from docweave.operators.upsert import latest_of
from docweave.schema import DOCUMENT
from docweave.sinks.store import write_documents


def stream_files(spark: SparkSession, root: str, per_trigger: int = 1000) -> DataFrame:
    """New files below ``root`` as (path, modified, length, content)."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = (
        spark.readStream.format("binaryFile")
        .schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", per_trigger)
        .load(root)
    )
    return files.withColumnRenamed("modificationTime", "modified")


def stream_table(spark: SparkSession, root: str, schema, pattern: str = "*.parquet") -> DataFrame:
    """New table files below ``root`` as rows."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(root)


def ingest_stream(
    source: DataFrame, to_documents: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """Start the stream: what is there now is ingested, then it stops.

    Each batch is appended under its own folder and a repeated batch replaces
    itself, so a restart from the checkpoint stores nothing twice.
    """

    def store(batch: DataFrame, number: int) -> None:
        write_documents(to_documents(batch), f"{path}/batch={number}", mode="overwrite")

    return (
        source.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def compact(spark: SparkSession, path: str, target: str) -> None:
    """One document per id from all batches, the latest batch winning.

    The latest batch of each id is found on narrow rows; of two rows of one id in
    it the same one is picked each time. Folder names are read as text.
    Run now and then: a rewrite per batch would cost the whole table each time.
    """
    schema = T.StructType([*DOCUMENT.fields, T.StructField("batch", T.LongType())])
    batches = spark.read.schema(schema).parquet(path)
    last = batches.groupBy("unique_id").agg(F.max("batch").alias("batch"))
    newest = latest_of(batches.join(last, ["unique_id", "batch"], "left_semi").drop("batch"))
    write_documents(newest, target, mode="errorifexists")

