"""Feed -> topic: the producer re-aimed as a Spark job (batch or stream).

documents -> fan-out of the days in [start, end] -> number -> emission order
-> bytes -> topic (file-backed or Kafka). Strict by default: a day of the
range missing from every document fails the job, before anything is sent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neoflow.operators.feed import (fan_out, first_numbers, in_days, in_emission_order, missing_days,
                                    object_counts, parse_feed, to_message_bytes)
from neoflow.session import scratch_path
from neoflow.sinks.commits import CommitLog
from neoflow.sinks.topic import FILES, TopicSink, append_records, write_topic


#: Messages of a task that writes into a file-backed topic, whose partitions several tasks may write in order.
TASK_MESSAGES = 200_000


def feed_messages(doc_days: DataFrame, start, end, doc_col: str, num_partitions: int, sent: int = 0,
                  tasks: int | None = None) -> DataFrame:
    """Messages in emission order: (day_str, doc, pos, value, number, partition) from
    parsed (document, day) rows; ``sent`` messages were numbered before. ``tasks``: see ``in_emission_order``."""
    starts = first_numbers(doc_days, start, end, doc_col)
    total = object_counts(doc_days, start, end, doc_col).select(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).scalar()
    placed = in_emission_order(fan_out(doc_days, start, end, key_cols=[doc_col], starts=starts), total, num_partitions, tasks)
    return placed.withColumn("number", F.col("number") + F.lit(sent)) if sent else placed


class Numbers:
    """The running number over the micro-batches of a stream: how many messages were numbered before
    each batch, kept in a commit log under its checkpoint. A batch that is sent again gets its numbers again."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.log = CommitLog(spark, f"{checkpoint.rstrip('/')}/_numbers")

    def take(self, batch_id: int, n: int) -> int:
        """Messages numbered before the batch, which has ``n``."""
        last = self.log.last()
        if last is not None and last.payload["batch"] == batch_id:
            return last.payload["before"]
        before = last.payload["before"] + last.payload["n"] if last is not None else 0
        version = last.version + 1 if last is not None else 0
        self.log.begin(version, {"batch": batch_id, "before": before, "n": n})
        self.log.finish(version)
        return before


def feed_to_topic(spark: SparkSession, docs: DataFrame, start, end, sink: TopicSink,
                  doc_col: str = "doc_path", strict: bool = True,
                  num_partitions: int | None = None,
                  doc_fields: list | None = None, numbers: Numbers | None = None, batch_id: int | None = None,
                  writer: str | None = None, sent_path: str | None = None) -> None:
    """Send every object of the days in [start, end] as one message (value
    only, with its topic partition). The run of message numbers is cut into
    ``num_partitions`` topic partitions, each written in order by one task; for
    Kafka give the topic's partition count (1 by default, as a total order
    needs), for files it is the session's shuffle partitions.

    In a stream ``numbers`` goes on from the batches before ``batch_id``, and a file-backed topic
    takes each batch of ``writer`` once. ``sent_path`` keeps what was sent: (number, day_str, doc,
    pos, partition), a folder a batch."""
    # The parsed (document, day) rows feed the missing-day check, the numbers
    # and the messages: parsed once, written to the shared folder. The document
    # key is a column of ``docs`` (e.g. the file path) or a member of the
    # document itself (``doc_fields``, e.g. a page number).
    in_doc = doc_col in [name for name, _ in doc_fields or []]
    path = scratch_path(spark, "feed-days")
    parsed = parse_feed(docs, key_cols=[] if in_doc else [doc_col], doc_fields=doc_fields)
    parsed.filter(in_days(start, end)).write.parquet(path)
    doc_days = spark.read.parquet(path)
    if strict:
        # Checked before anything is sent (a Kafka sink is not atomic):
        # at most one row comes back to the driver.
        miss = missing_days(spark, doc_days, start, end).select("day_str").take(1)
        if miss:
            raise KeyError(f"feed has no objects list for day {miss[0].day_str}")
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions")) if sink.kind == FILES else 1
    sent, tasks = 0, None
    if numbers is not None or sink.kind == FILES:
        n = object_counts(doc_days, start, end, doc_col).agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
        if numbers is not None:
            sent = numbers.take(batch_id, n)
        if sink.kind == FILES and n > TASK_MESSAGES * num_partitions:
            tasks = -(-n // TASK_MESSAGES)
    msgs = feed_messages(doc_days, start, end, doc_col, num_partitions, sent, tasks)
    if sent_path is not None:
        (msgs.select("number", "day_str", F.col(doc_col).alias("doc"), "pos", "partition")
         .write.mode("overwrite").parquet(f"{sent_path.rstrip('/')}/batch={batch_id or 0}"))
    recs = to_message_bytes(msgs.select("value", "partition"))
    if sink.kind == FILES:
        append_records(spark, recs, sink, writer=writer, batch=batch_id)
    else:
        write_topic(recs, sink)


def feed_to_topic_stream(spark: SparkSession, docs_path: str, start, end, sink: TopicSink,
                         checkpoint: str, strict: bool = False, trigger: dict | None = None,
                         max_files_per_trigger: int | None = None, num_partitions: int | None = None,
                         sent_path: str | None = None):
    """Streaming producer: every micro-batch of newly landed feed documents
    (one file each) is fanned out by the batch job into the topic.

    The running number goes on over micro-batches and restarts. A file-backed topic takes each batch
    once; to Kafka a batch replayed after a failure is sent again, as with any producer, under
    the same numbers. Lenient by default: a stream of documents rarely covers the
    whole range in one batch."""
    from neoflow.sources.feed import read_feed_documents_stream

    docs = read_feed_documents_stream(spark, docs_path, max_files_per_trigger)
    numbers = Numbers(spark, checkpoint)

    def send(batch: DataFrame, batch_id: int) -> None:
        feed_to_topic(batch.sparkSession, batch, start, end, sink, doc_col="doc_path",
                      strict=strict, num_partitions=num_partitions, numbers=numbers, batch_id=batch_id,
                      writer=checkpoint, sent_path=sent_path)

    return (docs.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())
