"""Folders of mixed files."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.functions.media import HEAD, media_type
from docweave.functions.paths import OUTPUT_FOLDER

# Files of up to so many bytes are read whole for their first ones.
WHOLE = 4 << 20


def folder_scan(spark: SparkSession, root: str, exclude: str = OUTPUT_FOLDER) -> DataFrame:
    """Every file below ``root`` as (path, modified, length, content).

    Paths holding ``exclude`` are skipped. The content is only read when it is
    used. Spark leaves out names starting with ``_`` or ``.``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.where(~F.contains(F.col("path"), F.lit(exclude))).select(
        "path", F.col("modificationTime").alias("modified"), "length", "content"
    )


def first_bytes(spark: SparkSession, paths: list[str], size: int = HEAD) -> list[bytes]:
    """The first ``size`` bytes of each file, in whatever store Spark reads."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def head(path: str) -> bytes:
        place = jvm.org.apache.hadoop.fs.Path(path)
        stream = place.getFileSystem(conf).open(place)
        try:
            return bytes(stream.readNBytes(size))
        finally:
            stream.close()

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(head, paths))


def with_media_type(files: DataFrame) -> DataFrame:
    """Files of ``folder_scan`` with the media type told by their first bytes and name.

    Spark reads a file whole or not at all, into one array of two GB at most. So
    only files of up to ``WHOLE`` bytes are read by tasks; larger ones are opened
    once each from the driver, which lists the folder as well, and ``HEAD`` bytes
    of them are read there. The files of a stream are read whole.
    """
    if files.isStreaming:
        return files.withColumn("content_type", media_type(F.col("content"), F.col("path")))
    # Comparisons of the length alone reach the scan: it leaves the content of other files unread.
    small, large = files.where(F.col("length") <= WHOLE), files.where(F.col("length") > WHOLE)
    paths = sorted({r.path for r in large.select("path").collect()})
    spark = files.sparkSession
    heads = pa.table({"path": pa.array(paths, pa.string()), "_head": pa.array(first_bytes(spark, paths), pa.binary())})
    large = large.join(spark.createDataFrame(heads), "path", "left").select(*files.columns, "_head")
    heads = small.withColumn("_head", F.substring("content", 1, HEAD)).unionByName(large)
    return heads.withColumn("content_type", media_type(F.col("_head"), F.col("path"))).drop("_head")


class ReaderRegistry:
    """Readers by media type: ``media type -> function(files) -> records``."""

    def __init__(self) -> None:
        self._readers: dict[str, object] = {}

    def register(self, kind: str, reader) -> None:
        self._readers[kind] = reader

    def read(self, files: DataFrame) -> dict[str, DataFrame]:
        """Records of each registered type, as lazy plans over the same files."""
        typed = with_media_type(files)
        return {kind: reader(typed.where(F.col("content_type") == kind)) for kind, reader in self._readers.items()}
