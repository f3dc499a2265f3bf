"""Streaming queries (SRC-*, SNK-*, STR-*) on file-backed topics.

Each query runs its stream to completion (``availableNow``, or a
processing-time trigger until caught up), then returns the landed table read
back in batch. Outputs and checkpoints go to new folders under the shared
folder (``spark.checkpoint.dir``)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from neoflow.operators.offsets import from_offsets, start_at_latest
from neoflow.operators.parse import parse_and_flatten
from neoflow.plans import fixtures as fx
from neoflow.operators.predicates import date_range
from neoflow.plans.q_flatten import DATE_HI, DATE_LO, FLATTEN_SQL
from neoflow.plans.registry import register, register_subset
from neoflow.plans.tables import table
from neoflow.fs import delete_path
from neoflow.plans.topics_fixture import new_topic, payload_slices, payload_topic, payload_topic_records
from neoflow.schemas import OUTPUT_SCHEMA
from neoflow.session import scratch_path
from neoflow.sinks.parquet import landed_table, parquet_append_stream
from neoflow.sinks.topic import CODEC, append_records
from neoflow.sources.topic import FILES, TopicSource, read_topic, read_topic_stream
from neoflow.streaming.jobs import (AVAILABLE_NOW, landing_stream, run_available_now, run_until_caught_up,
                                    topic_to_parquet)

# The last run's progress per query name, for tests (batches, rows).
LAST_PROGRESS: dict[str, list[dict]] = {}


def _land(spark: SparkSession, name: str, src: TopicSource, trigger=None):
    out = scratch_path(spark, f"landed-{name}")
    qs = topic_to_parquet(spark, src, out, trigger=trigger or AVAILABLE_NOW)
    if trigger and "processingTime" in trigger:
        run_until_caught_up(qs)
    else:
        run_available_now(qs)
    LAST_PROGRESS[name] = [dict(p) for p in qs[0].recentProgress]
    return landed_table(spark, out)


@register("stream_to_parquet", FLATTEN_SQL,
          ["SRC-2", "SNK-1", "STR-2", "STR-4", "STR-6", "STR-8"])
def stream_to_parquet(spark, sf_dir):
    """Topic -> decode -> parse -> flatten -> Parquet by date (availableNow)."""
    src = TopicSource(kind=FILES, path=payload_topic(spark, sf_dir), starting="earliest")
    return _land(spark, "stream_to_parquet", src)


@register("str_01_processing_time", FLATTEN_SQL, ["STR-1"])
def str_01_processing_time(spark, sf_dir):
    """Same job on the reference's 5-second processing-time trigger."""
    src = TopicSource(kind=FILES, path=payload_topic(spark, sf_dir), starting="earliest")
    return _land(spark, "str_01_processing_time", src, trigger={"processingTime": "5 seconds"})


@register("stream_restart", FLATTEN_SQL, ["STR-3"])
def stream_restart(spark, sf_dir):
    """Two runs on one checkpoint; the topic grows between them. Every
    message lands exactly once."""
    sink = new_topic(spark, "restart", fx.PAYLOAD_TOPIC)
    src = TopicSource(kind=FILES, path=sink.path, starting="earliest")
    out = scratch_path(spark, "landed-restart")
    slices = payload_slices(spark, sf_dir)
    half = len(slices) // 2
    for run in (slices[:half], slices[half:]):
        for part in run:
            append_records(spark, part, sink)
        run_available_now(topic_to_parquet(spark, src, out, trigger=AVAILABLE_NOW))
    return landed_table(spark, out)


@register("stream_rate_limited", FLATTEN_SQL, ["STR-7"])
def stream_rate_limited(spark, sf_dir):
    """At most two topic files per micro-batch (several batches)."""
    src = TopicSource(kind=FILES, path=payload_topic(spark, sf_dir), starting="earliest",
                      max_per_trigger=2)
    return _land(spark, "stream_rate_limited", src)


@register("stream_batches_counted",
          "SELECT count(*) AS n_rows, 3 AS n_batches FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey",
          ["STR-7"])
def stream_batches_counted(spark, sf_dir):
    """Five topic files at two files per micro-batch: three batches."""
    path = scratch_path(spark, "topic-five")
    recs = payload_topic_records(spark, sf_dir)
    # Put together rather than dealt out again; a topic of fewer than five scan tasks is small.
    five = recs.coalesce(5) if recs.rdd.getNumPartitions() >= 5 else recs.repartition(5)
    five.write.option("compression", CODEC).parquet(path)
    out = scratch_path(spark, "landed-batches")
    stream = landing_stream(spark, TopicSource(kind=FILES, path=path, starting="earliest", max_per_trigger=2))
    query = parquet_append_stream(stream, out, partition_by=None, trigger=AVAILABLE_NOW)
    run_available_now([query])
    batches = [p for p in query.recentProgress if p["numInputRows"] > 0]
    return landed_table(spark, out).agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(batches)).alias("n_batches"))


@register("live_view", FLATTEN_SQL, ["STR-5"])
def live_view_query(spark, sf_dir):
    """Two independent queries on one stream plan, each with its own checkpoint:
    what the second one has landed."""
    src = TopicSource(kind=FILES, path=payload_topic(spark, sf_dir), starting="earliest")
    first, second = scratch_path(spark, "landed-first"), scratch_path(spark, "landed-second")
    stream = landing_stream(spark, src)
    run_available_now([parquet_append_stream(stream, p, trigger=AVAILABLE_NOW) for p in (first, second)])
    return landed_table(spark, second)


@register("live_view_preview", f"""
SELECT least(5, count(*)) AS n_shown, 0 AS n_wrong FROM ({FLATTEN_SQL}) q""", ["SNK-2", "STR-5"])
def live_view_preview(spark, sf_dir):
    """The live view's own output: at most five rows of each batch (one batch here),
    each of them a row of the stream."""
    src = TopicSource(kind=FILES, path=payload_topic(spark, sf_dir), starting="earliest")
    out, shown = scratch_path(spark, "landed-view"), []
    run_available_now(topic_to_parquet(spark, src, out, trigger=AVAILABLE_NOW, view="objects_live_view", view_rows=5,
                                       on_preview=lambda _, rows: shown.extend(rows)))
    rows = spark.createDataFrame(shown, OUTPUT_SCHEMA)  # bounded: five rows a batch
    wrong = rows.exceptAll(landed_table(spark, out))
    return wrong.agg(F.lit(len(shown)).alias("n_shown"), F.count(F.lit(1)).alias("n_wrong"))


@register("src_04_fail_on_data_loss", FLATTEN_SQL + "\nWHERE o.o_orderdate < TIMESTAMP '1998-01-01'", ["SRC-4"])
def src_04_fail_on_data_loss(spark, sf_dir):
    """failOnDataLoss=false: files of the topic that go between listing and reading are
    skipped (``ignoreMissingFiles``), the others' rows are kept."""
    sink = new_topic(spark, "lossy", fx.PAYLOAD_TOPIC)
    src = TopicSource(kind=FILES, path=sink.path, starting="earliest", fail_on_data_loss=False)
    *kept, last = payload_slices(spark, sf_dir)
    for part in kept:
        append_records(spark, part, sink)
    before = set(read_topic(spark, src).inputFiles())
    append_records(spark, last, sink)
    listed = read_topic(spark, src)
    for path in set(listed.inputFiles()) - before:
        delete_path(spark, path)
    return parse_and_flatten(listed)


@register("src_05_one_topic", """
SELECT event_type AS topic, event_id AS "offset", props AS value FROM events
WHERE event_type = 'click' AND "ts" >= TIMESTAMP '2024-01-10'""", ["SRC-2", "SRC-5"])
def src_05_one_topic(spark, sf_dir):
    """Replay of one topic, by name and from an instant, out of a folder that holds all topics of ``events``."""
    sink = new_topic(spark, "all-events", "events")
    recs = fx.event_records(spark, sf_dir)
    recs.write.mode("append").parquet(sink.path)
    start = 1_704_844_800_000  # 2024-01-10 00:00 UTC
    replay = read_topic(spark, TopicSource(kind=FILES, path=sink.path, topic="click", starting="earliest",
                                           starting_timestamp=start))
    return (replay.filter(F.col("timestamp") >= F.timestamp_millis(F.lit(start)))
            .select("topic", "offset", F.col("value").cast("string").alias("value")))


@register("src_05_topic_replay", FLATTEN_SQL, ["SRC-5"])
def src_05_topic_replay(spark, sf_dir):
    """Bounded batch replay of the whole topic from the beginning."""
    recs = read_topic(spark, TopicSource(kind=FILES, path=payload_topic(spark, sf_dir)))
    return parse_and_flatten(recs)


@register("snk_03_topic_sink", FLATTEN_SQL, ["SNK-3"])
def snk_03_topic_sink(spark, sf_dir):
    """Messages appended to a topic in several runs: the values written, read back and parsed."""
    sink = new_topic(spark, "sink", fx.PAYLOAD_TOPIC)
    for part in payload_slices(spark, sf_dir):
        append_records(spark, part, sink)
    return parse_and_flatten(read_topic(spark, TopicSource(kind=FILES, path=sink.path)))


ROUTING_SQL = """
SELECT date, count(*) AS n FROM (
  SELECT strftime(o.o_orderdate, '%Y-%m-%d') AS date
  FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  UNION ALL SELECT NULL AS date FROM documents) t
GROUP BY date"""


@register("str_04_partition_routing", ROUTING_SQL, ["STR-4", "PRJ-2"])
def str_04_partition_routing(spark, sf_dir):
    """Rows land in ``date=<value>`` folders; unparseable messages (free
    text from ``documents``) land in the default partition as NULL dates."""
    sink = new_topic(spark, "routing", fx.PAYLOAD_TOPIC)
    for part in payload_slices(spark, sf_dir):
        append_records(spark, part, sink)
    bad = table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    append_records(spark, bad, sink)
    src = TopicSource(kind=FILES, path=sink.path, starting="earliest")
    landed = _land(spark, "str_04_partition_routing", src)
    return landed.groupBy("date").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------- start at latest

T0 = "2024-01-15 00:00:00"

START_AT_LATEST_SQL = f"""
WITH r AS (
  SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", event_id AS "offset",
         CAST(user_id AS VARCHAR) AS key, props AS value, ts
  FROM events),
s AS (
  SELECT topic, "partition", max("offset") + 1 AS start_offset
  FROM r WHERE ts < TIMESTAMP '{T0}' GROUP BY topic, "partition")
SELECT r.topic, r."partition", r."offset", r.key, r.value
FROM r LEFT JOIN s ON r.topic = s.topic AND r."partition" = s."partition"
WHERE r."offset" >= coalesce(s.start_offset, 0)"""


@register("start_at_latest", START_AT_LATEST_SQL, ["SRC-3"])
def start_at_latest_query(spark, sf_dir):
    """A consumer first started when the topic held the events before T0:
    it skips them, and a restart does not move its start."""
    sink = new_topic(spark, "events", "events")
    recs = fx.event_records(spark, sf_dir)
    before = recs.filter(F.col("timestamp") < F.lit(T0).cast("timestamp"))
    after = recs.filter(~(F.col("timestamp") < F.lit(T0).cast("timestamp")) | F.col("timestamp").isNull())
    before.write.mode("append").parquet(sink.path)

    out = scratch_path(spark, "landed-latest")
    ckpt = f"{out}/_checkpoints/records"
    src = TopicSource(kind=FILES, path=sink.path, starting="latest")

    def run():
        starts = start_at_latest(spark, read_topic(spark, src), ckpt)
        stream = from_offsets(read_topic_stream(spark, src), starts).select(
            "topic", "partition", "offset", F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"))
        run_available_now([parquet_append_stream(stream, out, ckpt, "topic", AVAILABLE_NOW)])

    run()                      # first start: fixes the start offsets, reads nothing new
    after.write.mode("append").parquet(sink.path)
    run()                      # restart: the stored start offsets still apply
    return spark.read.parquet(out).select("topic", "partition", "offset", "key", "value")


@register("landed_date_range",
          FLATTEN_SQL + f"\nWHERE strftime(o.o_orderdate, '%Y-%m-%d') BETWEEN '{DATE_LO}' AND '{DATE_HI}'",
          ["PRJ-12", "SNK-1"])
def landed_date_range(spark, sf_dir):
    """The closed date range read from the landed table: a partition filter
    on the date folders (only the folders in range are listed and read)."""
    src = TopicSource(kind=FILES, path=payload_topic(spark, sf_dir), starting="earliest")
    return date_range(_land(spark, "landed_date_range", src), "date", DATE_LO, DATE_HI)


# ---------------------------------------------------------------- per id

_OBJ = ["date", "object_id", "object_name", "close_approach_date_full"]
register_subset("src_02_topic_stream_scan", "stream_to_parquet", _OBJ, ["SRC-2"])
register_subset("snk_01_parquet_append", "stream_to_parquet", _OBJ, ["SNK-1"])
register_subset("str_02_append_mode", "stream_to_parquet", _OBJ, ["STR-2"])
register_subset("str_06_await_termination", "stream_to_parquet", _OBJ, ["STR-6"])
register_subset("str_08_topic_to_parquet", "stream_to_parquet",
                ["date", "object_id", "object_neo_reference_id", "absolute_magnitude_h",
                 "relative_velocity_km_per_sec", "miss_distance_kilometers", "is_sentry_object"],
                ["STR-8"])
register_subset("str_03_restart", "stream_restart", _OBJ, ["STR-3"])
register_subset("str_05_two_queries", "live_view", _OBJ, ["STR-5"])
register_subset("snk_02_live_view", "live_view_preview", ["n_shown", "n_wrong"], ["SNK-2"])
register_subset("str_07_rate_limit", "stream_rate_limited", _OBJ, ["STR-7"])
register_subset("src_03_start_at_latest", "start_at_latest",
                ["topic", "partition", "offset"], ["SRC-3"])
register_subset("src_05_replay_columns", "src_05_topic_replay", _OBJ, ["SRC-5"])

