"""Compaction of a growing topic: a snapshot of the latest value of each key, and the tail since then.

The snapshot is a table bucketed by (topic, partition, key); a run reduces the records
appended since the last one to one row a key, joins them with the snapshot bucket by
bucket (only the tail is shuffled), and writes the next snapshot. A commit log
names the snapshot and the offsets up to which it is complete, so that a run that
was cut off is simply made again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neoflow.operators.offsets import from_offsets, next_offsets
from neoflow.sinks.commits import CommitLog

_KEYS = ["topic", "partition", "key"]
_COLUMNS = "topic STRING, partition INT, key BINARY, offset BIGINT, value BINARY, timestamp TIMESTAMP"


def _table(spark: SparkSession, path: str, buckets: int) -> str:
    """Declares the bucketed table over a snapshot's folder in this session's catalog."""
    name = "compacted_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex
    by = ", ".join(f"`{k}`" for k in _KEYS)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_COLUMNS}) USING parquet "
              f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


def snapshot(spark: SparkSession, base: str) -> DataFrame | None:
    """The last snapshot: (topic, partition, key, offset, value, timestamp), deleted keys left out."""
    last = _last(spark, base)
    return None if last is None else spark.table(_table(spark, last["path"], last["buckets"]))


def _last(spark: SparkSession, base: str) -> dict | None:
    last = CommitLog(spark, f"{base.rstrip('/')}/_commits").last()
    return None if last is None else last.payload


def tail_by_key(records: DataFrame, covered: DataFrame | None) -> DataFrame:
    """Of each key's records from the covered offsets on the last one, tombstones included."""
    tail = (records if covered is None else from_offsets(records, covered)).filter("key is not null and offset is not null")
    return tail.groupBy(*_KEYS).agg(F.max_by(F.struct("offset", "value", "timestamp"), "offset").alias("r")) \
        .select(*_KEYS, "r.offset", "r.value", "r.timestamp")


def merged(old: DataFrame, tail: DataFrame) -> DataFrame:
    """A snapshot and the tail's last records -> the next snapshot."""
    new = tail.select(*_KEYS, F.struct("offset", "value", "timestamp").alias("n"))
    was = old.select(*_KEYS, F.struct("offset", "value", "timestamp").alias("o"))
    last = F.when(F.col("n").isNull() | (F.col("o.offset") >= F.col("n.offset")), F.col("o")).otherwise(F.col("n"))
    return (was.join(new, _KEYS, "full").withColumn("r", last).filter("r.value is not null")
            .select(*_KEYS, "r.offset", "r.value", "r.timestamp"))


def compact(spark: SparkSession, records: DataFrame, base: str, buckets: int) -> DataFrame:
    """One run: the snapshot under ``base`` brought up to the topic's present end -> the new snapshot.

    The first run reads the whole topic, later ones the snapshot and the records since then. A
    key's order is that of its offsets; a null value deletes it; records without a key are
    not kept."""
    log = CommitLog(spark, f"{base.rstrip('/')}/_commits")
    last = log.last()
    folder = f"{base.rstrip('/')}/{uuid.uuid4().hex[:12]}"
    # The ends are fixed first: records that come while the run reads belong to the next one.
    covered = None if last is None else spark.read.parquet(last.payload["ends"])
    ends = next_offsets(records.filter("offset is not null"))
    if covered is not None:
        ends = ends.unionByName(covered).groupBy("topic", "partition").agg(F.max("start_offset").alias("start_offset"))
    ends.write.parquet(f"{folder}/ends")
    stop = spark.read.parquet(f"{folder}/ends").select(
        F.col("topic").alias("_t"), F.col("partition").alias("_p"), F.col("start_offset").alias("_stop"))
    now = records.join(stop, F.col("topic").eqNullSafe(F.col("_t")) & F.col("partition").eqNullSafe(F.col("_p"))) \
        .filter("offset < _stop").select(*records.columns)
    tail = tail_by_key(now, covered)
    if last is not None:
        buckets = last.payload["buckets"]
        old = spark.table(_table(spark, last.payload["path"], buckets))
        new = merged(old, tail.repartition(buckets, *_KEYS))
    else:
        new = tail.filter("value is not null").repartition(buckets, *_KEYS)
    name = _table(spark, f"{folder}/data", buckets)
    new.select("topic", "partition", "key", "offset", "value", "timestamp").write.insertInto(name)
    version = 0 if last is None else last.version + 1
    log.begin(version, {"path": f"{folder}/data", "ends": f"{folder}/ends", "buckets": buckets})
    log.finish(version)
    return spark.table(name)
