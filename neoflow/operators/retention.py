"""Retention of a topic by size, and by whole files.

By size a partition keeps its newest records: one goes if the records after it alone
make up the limit. Bytes are summed up by ranges of offsets, ranges from the end
back, and records only inside the one range in which the limit falls, so no window
goes over a partition. Files are dropped whole, by their newest record's time, then
by size from the oldest on, as long as what stays makes up the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from neoflow.schemas import RECORD_SCHEMA

#: Offsets of a range: its records are what one window sorts.
RANGE = 1 << 16

_PLACE = ["topic", "partition"]


def record_bytes() -> Column:
    """Bytes of a record's key and value."""
    size = lambda c: F.coalesce(F.octet_length(c), F.lit(0)).cast("long")
    return size("key") + size("value")


def retention_by_size(records: DataFrame, max_bytes: int, size: Column | None = None, span: int = RANGE) -> DataFrame:
    """Records of each (topic, partition) that stay under ``max_bytes`` (a negative one: all): those
    after which fewer bytes follow than the limit. Records that share an offset stay or go together;
    records without an offset are kept."""
    if max_bytes < 0:
        return records
    sized = records.withColumn("_size", size if size is not None else record_bytes()) \
        .withColumn("_range", F.floor(F.col("offset") / F.lit(span)))
    after = Window.partitionBy(*_PLACE).orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranges = (sized.filter("_range is not null").groupBy(*_PLACE, "_range").agg(F.sum("_size").alias("_sum"))
              .withColumn("_after", F.coalesce(F.sum("_sum").over(after), F.lit(0)))
              .filter(F.col("_after") < F.lit(max_bytes))
              .select(F.col("topic").alias("_t"), F.col("partition").alias("_p"), F.col("_range").alias("_r"), "_after",
                      (F.col("_after") + F.col("_sum") >= F.lit(max_bytes)).alias("_edge")))
    at = F.col("topic").eqNullSafe(F.col("_t")) & F.col("partition").eqNullSafe(F.col("_p")) & (F.col("_range") == F.col("_r"))
    near = sized.join(ranges, at)
    later = Window.partitionBy(*_PLACE, "_range").orderBy(F.col("offset").desc()) \
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy(*_PLACE, "_range", "offset")
    inside = (near.filter("_edge")
              .withColumn("_upto", F.sum("_size").over(later) - F.sum("_size").over(same))
              .filter(F.col("_after") + F.col("_upto") < F.lit(max_bytes)))
    columns = records.columns
    return (near.filter("not _edge").select(*columns).unionByName(inside.select(*columns))
            .unionByName(sized.filter("offset is null").select(*columns)))


def segments(spark: SparkSession, path: str) -> DataFrame:
    """(topic, partition, file, newest, bytes, records) of a file-backed topic: what each file holds of each
    partition, its size shared out by the bytes of the records."""
    recs = spark.read.schema(RECORD_SCHEMA).parquet(path).select(
        *_PLACE, F.col("_metadata.file_path").alias("file"), "timestamp", "offset", record_bytes().alias("size"))
    return recs.groupBy(*_PLACE, "file").agg(
        F.max("timestamp").alias("newest"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_records"))


def expired_segments(files: DataFrame, asof: Column | str, hours: int = 168, max_bytes: int = -1) -> DataFrame:
    """``files`` (from ``segments``) with ``expired``: a partition's file goes if its newest record is older than
    ``hours`` at ``asof``, or if the files after it make up ``max_bytes`` (a negative one: no limit). One
    row a file is summed up, none a record."""
    now = F.lit(asof).cast("timestamp") if isinstance(asof, str) else asof
    old = F.coalesce(F.col("newest") < now - F.make_interval(hours=F.lit(hours)), F.lit(False))
    out = files.withColumn("_old", old)
    if max_bytes < 0:
        return out.withColumn("expired", F.col("_old")).drop("_old")
    after = Window.partitionBy(*_PLACE).orderBy(F.col("last_offset").desc(), F.col("file").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    alive = F.when(F.col("_old"), 0).otherwise(F.col("bytes"))
    return (out.withColumn("_after", F.coalesce(F.sum(alive).over(after), F.lit(0)))
            .withColumn("expired", F.col("_old") | (F.col("_after") >= F.lit(max_bytes))).drop("_old", "_after"))


def retained(spark: SparkSession, path: str, asof: Column | str, hours: int = 168, max_bytes: int = -1) -> DataFrame:
    """Records of a file-backed topic that file-wise retention leaves."""
    gone = expired_segments(segments(spark, path), asof, hours, max_bytes).filter("expired").select(
        F.col("topic").alias("_t"), F.col("partition").alias("_p"), F.col("file").alias("_f"))
    recs = spark.read.schema(RECORD_SCHEMA).parquet(path).withColumn("_file", F.col("_metadata.file_path"))
    at = (F.col("topic").eqNullSafe(F.col("_t")) & F.col("partition").eqNullSafe(F.col("_p")) & (F.col("_file") == F.col("_f")))
    return recs.join(gone, at, "left_anti").drop("_file")
