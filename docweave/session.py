"""Session settings, shared scratch space and reliable checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "docweave", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the engine relies on.

    Partition counts are left to AQE: start from many shuffle partitions and let
    it coalesce small ones and split skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **{k.replace("__", "."): str(v) for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset and
    Spark runs in one process (tests, a laptop) a temporary folder is made; on a
    cluster executors would each write to a disk of their own, so it raises.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    made = tempfile.mkdtemp(prefix="docweave-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, never used before."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "step") -> DataFrame:
    """``df`` written to the shared folder and read back.

    Later plans start from the files: they stay small, know their size, and a
    lost executor replays nothing. A checkpoint would carry the constraints of
    the plan before it, which pile up when steps repeat.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store Spark writes to."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
