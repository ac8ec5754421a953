"""The folder that a cluster's machines share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the checkpoint folder that the context was given. Where none is set a local session takes a temporary
    folder; on a cluster each machine would write to its own disk, so there it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return found or "file://" + os.path.join(tempfile.gettempdir(), "checkpoints", "siltbed")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder there, deleted when the driver's JVM ends."""
    where = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return where
