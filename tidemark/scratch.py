"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session: ``spark.checkpoint.dir``, or the one given to ``setCheckpointDir``.

    Without either, a temporary folder of this machine is used, and only where the whole session runs on it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tidemark-")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder path below the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The rows of ``frame`` as a Parquet table in the shared folder: lineage ends there."""
    spark = frame.sparkSession
    folder = scratch_folder(spark, name)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder whose rows nobody reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
