"""Topic writers (value only, no key, as the producer sends them).

Kafka: Spark's ``kafka`` sink (at-least-once). File-backed: Parquet files
with the record column set, appended to the topic folder. The topic assigns the
offsets, dense and unique in each (topic, partition):

1. The messages are written to a staging folder with their task and row, each
   task's messages of one partition in one run.
2. Runs are counted; a running sum over the tasks, from the partition's end on, is
   each run's first offset. Only run counts and partition ends are summed up.
3. The append is committed with its writer and batch id, then the staged messages
   are written with their offsets. An append that was cut off is finished first, from
   what it has staged; a batch that was committed is not written again.

Where each task has a partition of its own, a message's offset is known when it is staged: the
partition's end plus its row. Such messages are written once, and the committed files are
moved into the topic.

One writer at a time appends to a topic.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from neoflow.fs import delete_path, path_exists
from neoflow.schemas import RECORD_COLUMNS, RECORD_SCHEMA
from neoflow.sinks.commits import Commit, CommitLog

KAFKA = "kafka"
FILES = "files"


@dataclass
class TopicSink:
    """``num_partitions`` (files): messages without a partition go to that of their key's hash, those without
    a key to that of the task that writes them; without it, each task has a partition of its own."""

    kind: str = FILES
    path: str | None = None
    bootstrap: str | None = None
    topic: str | None = None
    num_partitions: int | None = None
    compression: str | None = None  # Kafka producer codec; None = broker/client default (none)
    extra: dict[str, str] = field(default_factory=dict)


def kafka_sink_options(sink: TopicSink) -> dict[str, str]:
    if not sink.bootstrap:
        raise ValueError("a Kafka sink needs bootstrap servers")
    opts = {"kafka.bootstrap.servers": sink.bootstrap}
    if sink.topic:
        opts["topic"] = sink.topic
    if sink.compression:
        opts["kafka.compression.type"] = sink.compression
    opts.update(sink.extra)
    return opts


def _kafka_frame(records: DataFrame) -> DataFrame:
    cols = [c for c in ("key", "value", "topic", "partition", "headers") if c in records.columns]
    out = records.select(*cols)
    if "partition" in out.columns:
        # Let the producer's partitioner pick unless a partition was chosen.
        out = out.withColumn("partition", F.col("partition").cast("int"))
    return out


def write_topic(records: DataFrame, sink: TopicSink) -> None:
    """Batch append of a record table (at least ``value``)."""
    if sink.kind == KAFKA:
        _kafka_frame(records).write.format("kafka").options(**kafka_sink_options(sink)).save()
        return
    append_records(records.sparkSession, records, sink)


def write_topic_stream(records: DataFrame, sink: TopicSink, checkpoint: str,
                       trigger: dict | None = None) -> StreamingQuery:
    """Streaming append of records: Kafka sink (at-least-once), or micro-batches appended to
    a file-backed topic, each committed with its batch id (exactly-once)."""
    if sink.kind == KAFKA:
        w = _kafka_frame(records).writeStream.format("kafka").options(**kafka_sink_options(sink))
    else:
        def send(batch: DataFrame, batch_id: int) -> None:
            append_records(batch.sparkSession, batch, sink, writer=checkpoint, batch=batch_id)

        w = records.writeStream.foreachBatch(send)
    w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


# ------------------------------------------------------------ file-backed appends

_RUN = ["topic", "partition", "_task"]
#: Codec of the files of a topic: messages of one topic repeat each other's member names.
CODEC = "zstd"


def _partition(messages: DataFrame, sink: TopicSink) -> Column:
    """The messages' own partition; where it is missing, by key, else by task (see TopicSink)."""
    chosen = F.spark_partition_id()
    if sink.num_partitions:
        n = F.lit(sink.num_partitions)
        chosen = F.pmod(chosen, n)
        if "key" in messages.columns:
            chosen = F.when(F.col("key").isNull(), chosen).otherwise(F.pmod(F.xxhash64("key"), n).cast("int"))
    if "partition" in messages.columns:
        return F.coalesce(F.col("partition").cast("int"), chosen)
    return chosen


def _record_frame(messages: DataFrame, sink: TopicSink, extra: list[Column]) -> DataFrame:
    """The record columns but the offset, missing ones filled: the topic from the sink, the
    time of the append (timestampType 1) where a record has none."""
    have = set(messages.columns)
    get = lambda name, dtype: F.col(name).cast(dtype) if name in have else F.lit(None).cast(dtype)
    stamp = get("timestamp", "timestamp")
    return messages.select(
        get("key", "binary").alias("key"), get("value", "binary").alias("value"),
        F.coalesce(get("topic", "string"), F.lit(sink.topic)).alias("topic"),
        _partition(messages, sink).alias("partition"),
        F.coalesce(stamp, F.current_timestamp()).alias("timestamp"),
        F.coalesce(get("timestampType", "int"), F.when(stamp.isNull(), F.lit(1)).otherwise(F.lit(0))).alias("timestampType"),
        *extra)


def append_records(spark: SparkSession, messages: DataFrame, sink: TopicSink,
                   num_partitions: int | None = None, writer: str | None = None,
                   batch: int | None = None, follow: tuple[str, str] | None = None) -> None:
    """Append messages to a file-backed topic, which assigns their offsets (given ones are not kept).

    ``num_partitions`` spreads the messages over that many tasks first. With ``writer`` and
    ``batch`` (ids that grow) an append that was committed before is skipped. The order of
    messages within a task and partition is that of their offsets. ``follow`` names a long column
    of the messages and a folder: runs in which it and the offsets go on by one are kept
    there, (topic, partition, first, target_first, n)."""
    if sink.kind != FILES or not sink.path:
        raise ValueError("a file-backed topic needs kind='files' and a path")
    log = CommitLog(spark, f"{sink.path.rstrip('/')}/_commits")
    own = follow is None and not sink.num_partitions and not {"topic", "partition"} & set(messages.columns)
    staged = None
    while True:
        last = recover(spark, sink)
        writers = dict(last.payload["writers"]) if last else {}
        if writer is not None and batch is not None and batch <= writers.get(writer, -1):
            return
        if own:
            payload = _stage_numbered(spark, messages, sink, num_partitions, last)
        else:
            if staged is None:
                staged = _stage(spark, messages, sink, num_partitions, follow)
            payload = {"staged": staged, "follow": follow, **_place(spark, sink, staged, last)}
        if writer is not None:
            writers[writer] = batch
        try:
            commit = log.begin(last.version + 1 if last else 0, payload | {"writers": writers})
        except FileExistsError:
            if own:  # numbered from ends that have moved on
                delete_path(spark, payload["moved"], recursive=True)
            continue
        _finish(spark, sink, log, commit, False)
        return


def recover(spark: SparkSession, sink: TopicSink) -> Commit | None:
    """The topic's last append, finished if it was cut off."""
    log = CommitLog(spark, f"{sink.path.rstrip('/')}/_commits")
    last = log.last()
    if last is not None and not last.done:
        _finish(spark, sink, log, last, True)
    return last


def topic_ends(spark: SparkSession, sink: TopicSink) -> DataFrame | None:
    """(topic, partition, next_offset) as of the last append; None if nothing was appended."""
    last = recover(spark, sink)
    return None if last is None else spark.read.parquet(last.payload["ends"])


def _stage(spark: SparkSession, messages: DataFrame, sink: TopicSink, num_partitions: int | None,
           follow: tuple[str, str] | None) -> str:
    path = f"{sink.path.rstrip('/')}/_staged/{uuid.uuid4().hex[:12]}"
    extra = [F.col(follow[0]).alias("_followed")] if follow else []
    records = _record_frame(messages.repartition(num_partitions) if num_partitions else messages, sink, extra)
    if {"topic", "partition"} & set(messages.columns) or (sink.num_partitions and "key" in messages.columns):
        records = (records.withColumn("_arrival", F.monotonically_increasing_id())
                   .sortWithinPartitions("topic", "partition", "_arrival").drop("_arrival"))
    (records.withColumn("_task", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
     .write.option("compression", CODEC).parquet(path))
    return path


def _stage_numbered(spark: SparkSession, messages: DataFrame, sink: TopicSink, num_partitions: int | None,
                    last: Commit | None) -> dict:
    """Stages messages of which each task has a partition of its own with their offsets, and writes the partitions'
    ends after the append."""
    name = uuid.uuid4().hex[:12]
    path, ends_path = (f"{sink.path.rstrip('/')}/_{kind}/{name}" for kind in ("staged", "offsets"))
    ends = _ends(spark, sink, last)
    end = (ends.filter(F.col("topic").eqNullSafe(F.lit(sink.topic)))
           .select(F.col("partition").alias("_p"), F.col("next_offset").alias("_end")))
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    records = _record_frame(messages.repartition(num_partitions) if num_partitions else messages, sink, [row.alias("_row")])
    # One row a partition of the topic: broadcast, so that the messages stay in their tasks.
    (records.join(F.broadcast(end), F.col("partition") == F.col("_p"), "left")
     .withColumn("offset", F.coalesce("_end", F.lit(0).cast("long")) + F.col("_row")).select(*RECORD_COLUMNS)
     .write.option("compression", CODEC).parquet(path))
    after = (spark.read.schema(RECORD_SCHEMA).parquet(path).groupBy("topic", "partition")
             .agg((F.max("offset") + 1).alias("next_offset")))
    _write_ends(ends, after, f"{ends_path}/ends")
    return {"moved": path, "ends": f"{ends_path}/ends"}


def _ends(spark: SparkSession, sink: TopicSink, last: Commit | None) -> DataFrame:
    """(topic, partition, next_offset) before an append."""
    if last is not None:
        return spark.read.parquet(last.payload["ends"])
    from neoflow.operators.offsets import next_offsets
    # A topic whose records were written with offsets of their own goes on from them.
    there = spark.read.schema(RECORD_SCHEMA).parquet(sink.path) if path_exists(spark, sink.path) and \
        _has_files(spark, sink.path) else spark.createDataFrame([], RECORD_SCHEMA)
    return next_offsets(there).withColumnRenamed("start_offset", "next_offset")


def _write_ends(ends: DataFrame, after: DataFrame, path: str) -> None:
    (ends.select("topic", "partition", "next_offset").unionByName(after)
     .groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset")).write.parquet(path))


def _place(spark: SparkSession, sink: TopicSink, staged: str, last: Commit | None) -> dict[str, str]:
    """Writes each run's first offset and the partitions' ends after the append."""
    base = f"{sink.path.rstrip('/')}/_offsets/{uuid.uuid4().hex[:12]}"
    ends = _ends(spark, sink, last)
    runs = (spark.read.parquet(staged).groupBy(*_RUN).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")))
    earlier = Window.partitionBy("topic", "partition").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    end = ends.select(F.col("topic").alias("_t"), F.col("partition").alias("_p"), F.col("next_offset").alias("_end"))
    at = F.col("topic").eqNullSafe(F.col("_t")) & F.col("partition").eqNullSafe(F.col("_p"))
    placed = (runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).join(end, at, "left")
              .select(*_RUN, "_first", "_n", (F.coalesce("_end", F.lit(0)) + F.col("_before")).alias("_base")))
    placed.write.parquet(f"{base}/runs")
    after = spark.read.parquet(f"{base}/runs").select("topic", "partition", (F.col("_base") + F.col("_n")).alias("next_offset"))
    _write_ends(ends, after, f"{base}/ends")
    return {"runs": f"{base}/runs", "ends": f"{base}/ends"}


def _has_files(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listed = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    return any(not s.getPath().getName().startswith(("_", ".")) for s in listed)


def _finish(spark: SparkSession, sink: TopicSink, log: CommitLog, commit: Commit, again: bool) -> None:
    """Writes a committed append's records; of one that was cut off those that aren't there yet."""
    if "moved" in commit.payload:
        _move_files(spark, commit.payload["moved"], sink.path)
        delete_path(spark, commit.payload["moved"], recursive=True)
        log.finish(commit.version)
        return
    runs = spark.read.parquet(commit.payload["runs"]).select(
        F.col("topic").alias("_t"), F.col("partition").alias("_p"), F.col("_task").alias("_k"), "_first", "_base")
    at = (F.col("topic").eqNullSafe(F.col("_t")) & F.col("partition").eqNullSafe(F.col("_p"))
          & (F.col("_task") == F.col("_k")))
    if again and not path_exists(spark, commit.payload["staged"]):
        log.finish(commit.version)  # written whole, the mark alone is missing
        return
    staged = (spark.read.parquet(commit.payload["staged"]).join(runs, at)
              .withColumn("offset", F.col("_base") + F.col("_row") - F.col("_first")))
    records = staged.select(*RECORD_COLUMNS)
    if commit.payload.get("follow"):
        # A folder of its own for each commit, so that doing it again replaces it. Both numbers
        # grow, so records that are equally far apart are one run.
        (staged.withColumn("_apart", F.col("offset") - F.col("_followed")).groupBy("topic", "partition", "_apart")
         .agg(F.min("_followed").alias("first"), F.min("offset").alias("target_first"), F.count(F.lit(1)).alias("n"))
         .drop("_apart").write.mode("overwrite").parquet(f"{commit.payload['follow'][1]}/commit={commit.version}"))
    if again and _has_files(spark, sink.path):
        least = runs.select(F.min("_base")).first()[0]
        there = (spark.read.schema(RECORD_SCHEMA).parquet(sink.path).filter(F.col("offset") >= F.lit(least))
                 .select(F.col("topic").alias("_t"), F.col("partition").alias("_p"), F.col("offset").alias("_o")))
        records = records.join(there, F.col("topic").eqNullSafe(F.col("_t")) & (F.col("partition") == F.col("_p"))
                               & (F.col("offset") == F.col("_o")), "left_anti")
    records.write.mode("append").option("compression", CODEC).parquet(sink.path)
    delete_path(spark, commit.payload["staged"], recursive=True)
    log.finish(commit.version)


def _move_files(spark: SparkSession, source: str, target: str) -> None:
    """The data files of a folder into another one; those of a move that was cut off are there already."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    p, to = path(source), path(target)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return
    fs.mkdirs(to)
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")) and not fs.rename(status.getPath(), path(to, name)):
            raise OSError(f"{name} of {source} can't be moved to {target}")


def create_topic(spark, sink: TopicSink) -> None:
    """An empty file-backed topic (the folder, so readers can start on it)."""
    empty = spark.createDataFrame([], RECORD_SCHEMA)
    empty.write.mode("append").parquet(sink.path)
