"""The folder that driver and executors share, for data that a query derives on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, removed with the JVM. Only where all run in one process may the session name none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="dirbook-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(hadoop)
    files.deleteOnExit(hadoop)
    return path
