"""The folder for tables and files that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where that is unset, a temporary folder
    of this session on a local master, where all tasks see it; an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master, app = spark.sparkContext.master, spark.sparkContext.applicationId
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="boxloom-")
    return _OWN[app]


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder that no later step reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
