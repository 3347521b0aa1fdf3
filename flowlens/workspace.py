"""Where intermediate tables go."""

import uuid

from pyspark.sql import SparkSession


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``.

    The setting is required: all executors must see the folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/flowlens/{name}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a finished job no longer needs, in whatever store it is."""
    files, folder = _folder(spark, path)
    files.delete(folder, True)
