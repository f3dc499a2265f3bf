"""Feed documents landed as files: one JSON document per file (pretty-printed
over many lines is fine), e.g. saved API responses.

Each file becomes one row (``wholetext``); the document key used for
ordering is the file path, or a partition column of the folder layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_feed_documents(spark: SparkSession, path: str) -> DataFrame:
    """(value, doc_path, <partition columns>) - one row per document file."""
    # wholetext goes through text()'s own argument (an earlier .option() would
    # be overwritten by its default).
    df = spark.read.text(path, wholetext=True)
    return df.withColumn("doc_path", F.col("_metadata.file_path"))


def read_feed_documents_stream(spark: SparkSession, path: str,
                               max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.text(path, wholetext=True).withColumn("doc_path", F.col("_metadata.file_path"))


def read_feed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Feed documents as JSON Lines: one document per line, many per file
    (splittable; the documents carry their own order key, e.g. a page)."""
    return spark.read.text(path)
