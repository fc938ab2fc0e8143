"""Shared storage for written intermediate tables."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else the session's checkpoint folder.

    Executors must all reach it, so there is no default: without one this is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return root.rstrip("/")


def use_scratch(spark: SparkSession, folder: str) -> None:
    """Name ``folder`` as the shared folder of a session that has none."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/smelter/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote and no longer needs."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of results that are written and no longer referred to.

    Spark's cleaner does so once the driver has collected its garbage, which may be much later. What one
    collection lets go of holds more, so it takes a few, with time between for the cleaner.
    """
    for _ in range(4):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)
