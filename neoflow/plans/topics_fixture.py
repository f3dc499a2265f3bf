"""File-backed topics written from the fixtures into the shared folder.

A topic is written once per (application, sf_dir, layout) and reused by the
queries of the same session; every query gets its own output and checkpoint
folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neoflow.fs import path_exists
from neoflow.plans import fixtures as fx
from neoflow.session import scratch_path
from neoflow.sinks.topic import CODEC, FILES, TopicSink, append_records, create_topic

_CACHE: dict[tuple, str] = {}

# Payload slices by order date: the topic grows in this order, the way
# messages arrive over time.
SLICE_BOUNDS = ["1994-01-01", "1996-01-01", "1998-01-01"]


def _sliced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``payload_lines`` with their slice, joined once per application and kept as narrow rows: only a slice's
    messages are made of them, so orders and lines are not joined again for each slice."""
    lines = fx.payload_lines(spark, sf_dir)
    ts = F.col("o_orderdate").cast("timestamp")
    number = sum((F.when(ts >= F.lit(b).cast("timestamp"), 1).otherwise(0) for b in SLICE_BOUNDS), F.lit(0))
    sliced = lines.withColumn("slice", number)
    key = (spark.sparkContext.applicationId, sf_dir, "lines")
    path = _CACHE.get(key)
    if not (path and path_exists(spark, path)):
        path = scratch_path(spark, "payload-lines")
        (sliced.sortWithinPartitions("slice", "o_orderkey")
         .write.partitionBy("slice").option("compression", CODEC).parquet(path))
        _CACHE[key] = path
    return spark.read.schema(sliced.schema).parquet(path)


def payload_slices(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    lines = _sliced_lines(spark, sf_dir)
    return [fx.messages_of(lines.filter(F.col("slice") == i)).select("value", F.col("ts").alias("timestamp"))
            for i in range(len(SLICE_BOUNDS) + 1)]


def payload_topic(spark: SparkSession, sf_dir: str) -> str:
    """Whole payload as a file-backed topic (one append)."""
    key = (spark.sparkContext.applicationId, sf_dir, "payload")
    path = _CACHE.get(key)
    if path and path_exists(spark, path):
        return path
    path = scratch_path(spark, "topic-objects")
    sink = TopicSink(kind=FILES, path=path, topic=fx.PAYLOAD_TOPIC)
    msgs = fx.payload_messages(spark, sf_dir).select("value", F.col("ts").alias("timestamp"))
    # Coalesced, not shuffled: the messages are many times as wide as the rows they are made of,
    # and those of one order stay together.
    append_records(spark, msgs.coalesce(2 * spark.sparkContext.defaultParallelism), sink)
    _CACHE[key] = path
    return path


def new_topic(spark: SparkSession, name: str, topic: str) -> TopicSink:
    sink = TopicSink(kind=FILES, path=scratch_path(spark, f"topic-{name}"), topic=topic)
    create_topic(spark, sink)
    return sink


def payload_topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payload topic read back in batch (replay from the beginning)."""
    from neoflow.sources.topic import FILES as _FILES, TopicSource, read_topic
    return read_topic(spark, TopicSource(kind=_FILES, path=payload_topic(spark, sf_dir)))
