"""Tiny file-system checks through the session's Hadoop configuration (works
for any scheme the cluster supports)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(hconf).exists(p))


def delete_path(spark: SparkSession, path: str, recursive: bool = False) -> None:
    """Remove one file (``recursive``: or a folder)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, recursive)
