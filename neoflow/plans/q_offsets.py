"""Queries on offsets that a topic assigns, offset bounds, gaps, keyed state, retention
by size and files, mirrored offsets and self-describing messages (SNK-3, SRC-3..5,
TOP-1, TOP-3, TOP-4, TOP-6, TOP-7, FAN-3, FAN-5, FAN-7), all on ``events``."""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from neoflow.operators.compaction import compact
from neoflow.operators.envelope import by_schema, describe
from neoflow.operators.feed import fan_out_variant
from neoflow.operators.mirroring import mirror_to, offset_syncs, translate
from neoflow.operators.retention import retained, retention_by_size
from neoflow.operators.topics import lines_to_records
from neoflow.plans import fixtures as fx
from neoflow.plans.q_feed import FAN_OUT_SQL, OBJECT_SCHEMA, _bounds, _docs
from neoflow.plans.q_topics import RECORDS_CTE
from neoflow.plans.registry import register
from neoflow.plans.tables import table
from neoflow.plans.topics_fixture import new_topic
from neoflow.session import scratch_path
from neoflow.sinks.parquet import parquet_append_stream
from neoflow.sinks.topic import FILES, TopicSink, append_records, write_topic
from neoflow.sources.growing import read_growing_lines
from neoflow.sources.topic import TopicSource, read_topic, read_topic_stream
from neoflow.streaming.feed_job import feed_to_topic_stream
from neoflow.streaming.jobs import AVAILABLE_NOW, from_start, run_available_now
from neoflow.streaming.topic_state import STATE_STORE, find_gaps, latest_changes

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in the RocksDB store."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, STATE_STORE)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def event_slices(spark: SparkSession, sf_dir: str, n: int = 3) -> list[DataFrame]:
    """The event records in ``n`` parts by event id, as a topic grows, each in the order of the ids."""
    recs = fx.event_records(spark, sf_dir)
    last = table(spark, sf_dir, "events").select(F.max("event_id")).scalar()
    part = F.least(F.floor(F.col("offset") * n / (last + 1)), F.lit(n - 1))
    return [recs.filter(part == i).repartitionByRange("offset").sortWithinPartitions("offset") for i in range(n)]


def _texts(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in ("key", "value") if c in df.columns})


# ------------------------------------------------------------------- SNK-3

NUMBERED_CTE = RECORDS_CTE + """,
n AS (SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") - 1 AS place FROM r)"""


@register("topic_offsets", NUMBERED_CTE + """
SELECT topic, "partition", place AS "offset", key, value FROM n""", ["SNK-3"])
def topic_offsets(spark, sf_dir):
    """Three appends of several tasks into the same partitions, the second one sent twice:
    offsets are dense and unique in each partition, in the order of the events."""
    sink = new_topic(spark, "offsets", "events")
    slices = event_slices(spark, sf_dir)
    for batch, part in [(0, slices[0]), (1, slices[1]), (1, slices[1]), (2, slices[2])]:
        append_records(spark, part.drop("offset"), sink, writer="events", batch=batch)
    recs = read_topic(spark, TopicSource(kind=FILES, path=sink.path))
    return _texts(recs).select("topic", "partition", "offset", "key", "value")


@register("topic_lines_numbered", """
SELECT count(*) AS n_records, count(*) AS n_places, 3 AS n_partitions, true AS dense, 0 AS n_untimed
FROM (SELECT props FROM events UNION ALL SELECT props FROM events)""", ["TOP-1", "SNK-3", "SRC-3"])
def topic_lines_numbered(spark, sf_dir):
    """Lines written to an empty topic of three partitions after a consumer started there at
    latest, by batch and by stream: each has a place and a time, and all are read."""
    sink = TopicSink(kind=FILES, path=new_topic(spark, "numbered", "lines").path, topic="lines", num_partitions=3)
    src = TopicSource(kind=FILES, path=sink.path, starting="latest")
    out = scratch_path(spark, "landed-lines")
    ckpt = f"{out}/_checkpoints/lines"

    def consume():
        stream = from_start(spark, src, read_topic_stream(spark, src), ckpt)
        run_available_now([parquet_append_stream(stream, out, ckpt, None, AVAILABLE_NOW)])

    lines_dir = scratch_path(spark, "lines")
    table(spark, sf_dir, "events").select("props").write.text(lines_dir)
    consume()
    write_topic(lines_to_records(spark.read.text(lines_dir), "lines").repartition(4), sink)
    from neoflow.operators.topics import lines_to_topic_stream
    run_available_now([lines_to_topic_stream(spark, lines_dir, "lines", sink, scratch_path(spark, "ckpt-lines"), AVAILABLE_NOW)])
    consume()
    places = spark.read.parquet(out).groupBy("partition").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("offset").alias("places"), F.max("offset").alias("last"),
        F.count_if(F.col("timestamp").isNull()).alias("untimed"))
    return places.agg(F.sum("n").alias("n_records"), F.sum("places").alias("n_places"),
                      F.count(F.lit(1)).cast("int").alias("n_partitions"), F.bool_and(F.col("last") + 1 == F.col("n")).alias("dense"),
                      F.sum("untimed").cast("int").alias("n_untimed"))


# -------------------------------------------------------------- SRC-3, SRC-5

START_SPEC = '{"click": {"0": 1000, "1": 2000, "2": -2}, "view": {"1": 500}}'
END_SPEC = '{"click": {"0": 5000, "1": -1, "2": 4000}, "view": {"1": 3000}}'


@register("replay_between_offsets", RECORDS_CTE + """
SELECT topic, "partition", "offset", key, value FROM r
WHERE (topic = 'click' AND (("partition" = 0 AND "offset" >= 1000 AND "offset" < 5000)
       OR ("partition" = 1 AND "offset" >= 2000) OR ("partition" = 2 AND "offset" < 4000)))
   OR (topic = 'view' AND "partition" = 1 AND "offset" >= 500 AND "offset" < 3000)""", ["SRC-5"])
def replay_between_offsets(spark, sf_dir):
    """Bounded replay from a start spec to an end spec."""
    sink = new_topic(spark, "bounded", "events")
    for part in event_slices(spark, sf_dir):
        part.write.mode("append").parquet(sink.path)
    src = TopicSource(kind=FILES, path=sink.path, starting=START_SPEC)
    return _texts(read_topic(spark, src, END_SPEC)).select("topic", "partition", "offset", "key", "value")


STREAM_SPEC = '{"click": {"0": 100, "1": -1, "2": -2}, "view": {"0": -1}}'


@register("stream_from_offsets", RECORDS_CTE + """,
m AS (SELECT max("offset") AS top FROM r),
first AS (SELECT topic, "partition", max("offset") + 1 AS next FROM r, m
          WHERE "offset" * 3 // (top + 1) = 0 GROUP BY topic, "partition")
SELECT r.topic, r."partition", r."offset", r.key, r.value FROM r
LEFT JOIN first f ON f.topic = r.topic AND f."partition" = r."partition"
WHERE "offset" >= CASE WHEN r.topic = 'click' AND r."partition" = 0 THEN 100
  WHEN (r.topic = 'click' AND r."partition" = 1) OR (r.topic = 'view' AND r."partition" = 0) THEN coalesce(f.next, 0)
  ELSE 0 END""", ["SRC-3"])
def stream_from_offsets(spark, sf_dir):
    """A stream first started at an offset spec when the topic held a third of the events; a
    restart does not move its start."""
    sink = new_topic(spark, "from-offsets", "events")
    out = scratch_path(spark, "landed-from-offsets")
    ckpt = f"{out}/_checkpoints/records"
    src = TopicSource(kind=FILES, path=sink.path, starting=STREAM_SPEC)
    for part in event_slices(spark, sf_dir):
        part.write.mode("append").parquet(sink.path)
        stream = from_start(spark, src, read_topic_stream(spark, src), ckpt)
        run_available_now([parquet_append_stream(stream, out, ckpt, None, AVAILABLE_NOW)])
    return _texts(spark.read.parquet(out)).select("topic", "partition", "offset", "key", "value")


# ------------------------------------------------------------------- SRC-4

@register("stream_offset_gaps", RECORDS_CTE + """
SELECT topic, "partition", expected, "offset" AS found, "offset" - expected AS missing
FROM (SELECT topic, "partition", "offset",
             lag("offset") OVER (PARTITION BY topic, "partition" ORDER BY "offset") + 1 AS expected FROM r)
WHERE "offset" > expected""", ["SRC-4"])
def stream_offset_gaps(spark, sf_dir):
    """Gaps in the offsets of a topic that grows between three runs on one checkpoint: also those
    from one run to the next."""
    sink = new_topic(spark, "gaps", "events")
    src = TopicSource(kind=FILES, path=sink.path, starting="earliest")
    out = scratch_path(spark, "gaps-found")
    with rocksdb_state(spark):
        for part in event_slices(spark, sf_dir):
            part.write.mode("append").parquet(sink.path)
            gaps = find_gaps(read_topic_stream(spark, src))
            run_available_now([parquet_append_stream(gaps, out, f"{out}/_checkpoints/gaps", None, AVAILABLE_NOW)])
    return spark.read.parquet(out)


# ------------------------------------------------------------------- TOP-7

#: Every fifth event deletes its key.
_WITH_DELETES = RECORDS_CTE + """,
d AS (SELECT topic, "partition", key, "offset", CASE WHEN "offset" % 5 <> 0 THEN value END AS value FROM r WHERE key IS NOT NULL),
l AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY topic, "partition", key ORDER BY "offset" DESC) = 1)
SELECT topic, "partition", key, "offset", value FROM l WHERE value IS NOT NULL"""


def _with_deletes(part: DataFrame) -> DataFrame:
    return part.withColumn("value", F.when(F.col("offset") % 5 != 0, F.col("value")))


@register("stream_latest_per_key", _WITH_DELETES, ["TOP-7"])
def stream_latest_per_key(spark, sf_dir):
    """The latest value of each key as a stream of changes over three runs on one checkpoint; deleted
    keys leave the state. Of the changes each key's last one is taken."""
    sink = new_topic(spark, "keyed", "events")
    src = TopicSource(kind=FILES, path=sink.path, starting="earliest")
    out = scratch_path(spark, "changes")
    with rocksdb_state(spark):
        for part in event_slices(spark, sf_dir):
            _with_deletes(part).write.mode("append").parquet(sink.path)
            changes = latest_changes(read_topic_stream(spark, src), 0)
            run_available_now([parquet_append_stream(changes, out, f"{out}/_checkpoints/changes", None, AVAILABLE_NOW)])
    last = spark.read.parquet(out).groupBy("topic", "partition", "key").agg(
        F.max_by(F.struct("offset", "value"), "offset").alias("r")).filter("r.value is not null")
    return _texts(last.select("topic", "partition", "key", "r.offset", "r.value"))


@register("compacted_topic", _WITH_DELETES, ["TOP-7"])
def compacted_topic(spark, sf_dir):
    """A topic compacted after each of three appends: later runs join the bucketed snapshot with
    the records since the run before."""
    sink = new_topic(spark, "compacted", "events")
    base = scratch_path(spark, "snapshots")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for part in event_slices(spark, sf_dir):
        _with_deletes(part).write.mode("append").parquet(sink.path)
        found = compact(spark, read_topic(spark, TopicSource(kind=FILES, path=sink.path)), base, buckets)
    return _texts(found).select("topic", "partition", "key", "offset", "value")


# ------------------------------------------------------------------- TOP-6

RETAINED_BYTES = 4000


@register("retention_by_size", RECORDS_CTE + f"""
SELECT topic, "partition", "offset", key, value FROM (
  SELECT *, coalesce(sum(octet_length(encode(key)) + octet_length(encode(value))) OVER (
    PARTITION BY topic, "partition" ORDER BY "offset" DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS later
  FROM r) WHERE later < {RETAINED_BYTES}""", ["TOP-6"])
def retention_by_size_query(spark, sf_dir):
    """The newest records of each partition that make up 4,000 bytes."""
    kept = retention_by_size(fx.event_records(spark, sf_dir), RETAINED_BYTES, span=1000)
    return _texts(kept).select("topic", "partition", "offset", "key", "value")


SEGMENTS, SEGMENT_HOURS = 6, 400


@register("retention_of_files", RECORDS_CTE + f""",
s AS (SELECT *, "offset" * {SEGMENTS} // (SELECT max("offset") + 1 FROM r) AS seg,
        octet_length(encode(key)) + octet_length(encode(value)) AS size FROM r),
f AS (SELECT topic, "partition", seg, max("timestamp") AS newest, sum(size) AS bytes FROM s GROUP BY ALL),
o AS (SELECT *, newest < (SELECT max("timestamp") FROM r) - INTERVAL {SEGMENT_HOURS} HOUR AS old FROM f),
a AS (SELECT *, coalesce(sum(CASE WHEN old THEN 0 ELSE bytes END) OVER (PARTITION BY topic, "partition"
        ORDER BY seg DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS later FROM o)
SELECT s.topic, s."partition", s."offset", s.key, s.value FROM s
JOIN a ON a.topic = s.topic AND a."partition" = s."partition" AND a.seg = s.seg
WHERE NOT a.old AND a.later < {RETAINED_BYTES}""", ["TOP-6"])
def retention_of_files(spark, sf_dir):
    """Whole files go: those whose newest record is over 400 hours old, then the oldest
    as long as the later ones make up 4,000 bytes."""
    sink = new_topic(spark, "segments", "events")
    for part in event_slices(spark, sf_dir, SEGMENTS):
        part.coalesce(1).write.mode("append").parquet(sink.path)
    asof = fx.event_records(spark, sf_dir).select(F.max("timestamp")).scalar()
    kept = retained(spark, sink.path, asof, SEGMENT_HOURS, RETAINED_BYTES)
    return _texts(kept).select("topic", "partition", "offset", "key", "value")


# ------------------------------------------------------------------- TOP-4

MIRRORED = "click|view|sign.*"


def _mirrored(spark, sf_dir) -> TopicSink:
    sink = new_topic(spark, "mirror", "events")
    for batch, part in enumerate(event_slices(spark, sf_dir)):
        mirror_to(spark, part, sink, "A", "B", MIRRORED, batch=batch)
    return sink


@register("mirror_target_offsets", NUMBERED_CTE + f"""
SELECT 'A.' || topic AS topic, "partition", place AS "offset", key, value FROM n
WHERE regexp_full_match(topic, '{MIRRORED}')""", ["TOP-4"])
def mirror_target_offsets(spark, sf_dir):
    """A topic mirrored in three batches: the target's own offsets, in the source's order."""
    recs = read_topic(spark, TopicSource(kind=FILES, path=_mirrored(spark, sf_dir).path))
    return _texts(recs).select("topic", "partition", "offset", "key", "value")


@register("mirror_positions", NUMBERED_CTE + f""",
p AS (SELECT topic, "partition", "offset" + 1 AS position, place + 1 AS translated FROM n
      WHERE regexp_full_match(topic, '{MIRRORED}') AND "offset" % 10 = 0)
SELECT topic, "partition", position, translated, position AS translated_back FROM p
WHERE translated <= (SELECT max(place) FROM n WHERE n.topic = p.topic AND n."partition" = p."partition")
  AND (SELECT count(*) FROM n WHERE n.topic = p.topic AND n."partition" = p."partition" AND n."offset" = p.position) = 1
UNION ALL
SELECT topic, "partition", position, translated, (SELECT coalesce(min(n."offset"), p.position) FROM n
   WHERE n.topic = p.topic AND n."partition" = p."partition" AND n."offset" >= p.position) AS translated_back FROM p
WHERE NOT (translated <= (SELECT max(place) FROM n WHERE n.topic = p.topic AND n."partition" = p."partition")
  AND (SELECT count(*) FROM n WHERE n.topic = p.topic AND n."partition" = p."partition" AND n."offset" = p.position) = 1)
""", ["TOP-4"])
def mirror_positions(spark, sf_dir):
    """Positions after every tenth event, translated to the target and back again: to the source's
    next record, where one follows."""
    syncs = offset_syncs(spark, _mirrored(spark, sf_dir), "A")
    own = fx.event_records(spark, sf_dir).filter(F.col("topic").rlike(f"^(?:{MIRRORED})$") & (F.col("offset") % 10 == 0))
    positions = own.select("topic", "partition", (F.col("offset") + 1).alias("position"))
    there = translate(positions, syncs)
    asked = there.select(F.concat(F.lit("A."), "topic").alias("topic"), "partition", F.col("translated").alias("position"),
                         F.col("topic").alias("source"), F.col("position").alias("asked"))
    back = translate(asked, syncs, back=True)
    return back.select(F.col("source").alias("topic"), "partition", F.col("asked").alias("position"),
                       F.col("position").alias("translated"), F.col("translated").alias("translated_back"))


# ------------------------------------------------------------------- TOP-3

@register("described_messages", """
SELECT event_id, CASE WHEN event_type = 'click' THEN 'date' WHEN event_type = 'view' THEN 'timestamp' ELSE 'decimal(18,2)' END AS kind,
  CASE WHEN event_type = 'click' THEN strftime(ts, '%Y-%m-%d') WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
       ELSE (((user_id - event_id) * 25)::DECIMAL(18, 0) / 100)::DECIMAL(18, 2)::VARCHAR END AS what
FROM events""", ["TOP-3"])
def described_messages(spark, sf_dir):
    """Messages of three schemas (a date, a timestamp, a decimal) in one topic, each decoded by the
    schema it carries."""
    e = table(spark, sf_dir, "events").withColumn("rest", F.coalesce(F.col("event_type"), F.lit("")))
    kinds = [(F.col("rest") == "click", F.to_date("ts"), T.DateType()),
             (F.col("rest") == "view", F.date_trunc("second", "ts"), T.TimestampType()),
             (~F.col("rest").isin("click", "view"),
              ((F.col("user_id") - F.col("event_id")) * F.lit(25)).cast("decimal(18,0)") / F.lit(100), T.DecimalType(12, 2))]
    parts = []
    for chosen, what, dtype in kinds:
        full = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("what", dtype)])
        value = F.struct("event_id", what.cast(dtype).alias("what"))
        parts.append(e.filter(chosen).select(describe(value, full).alias("value")))
    sink = new_topic(spark, "described", "described")
    write_topic(reduce(DataFrame.unionByName, parts), sink)
    recs = read_topic(spark, TopicSource(kind=FILES, path=sink.path))

    def route(dtype: T.DataType, decoded: DataFrame) -> DataFrame:
        kind = dtype["what"].dataType
        what = F.col("payload.what")
        text = F.date_format(what, "yyyy-MM-dd HH:mm:ss") if isinstance(kind, T.TimestampType) else what.cast("string")
        return decoded.select("payload.event_id", F.lit(kind.simpleString()).alias("kind"), text.alias("what"))

    return by_schema(route, recs)


# ------------------------------------------------------------------- TOP-1

@register("growing_lines", "SELECT props AS value, count(*) AS n FROM events GROUP BY props", ["TOP-1"])
def growing_lines(spark, sf_dir):
    """Lines of a folder that grows between three runs on one checkpoint, each once."""
    folder, out = scratch_path(spark, "growing"), scratch_path(spark, "grown")
    for part in event_slices(spark, sf_dir):
        part.select(F.col("value").cast("string").alias("value")).write.mode("append").text(folder)
        lines = read_growing_lines(spark, folder)
        run_available_now([parquet_append_stream(lines, out, f"{out}/_checkpoints/lines", None, AVAILABLE_NOW)])
    return spark.read.parquet(out).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


# -------------------------------------------------------------- FAN-3, FAN-5, FAN-7

@register("feed_variant_route", FAN_OUT_SQL, ["FAN-3", "FAN-5"])
def feed_variant_route(spark, sf_dir):
    """The fan-out by way of a variant: each object is a row of its own from the start, no day's list
    is held as one value."""
    start, end = _bounds(spark, sf_dir)
    msgs = fan_out_variant(_docs(spark, sf_dir), start, end)
    return msgs.select(F.from_json("value", OBJECT_SCHEMA).alias("m")).select("m.*")


@register("feed_stream_numbers", """
SELECT count(*) AS n_messages, 1::BIGINT AS first_number, count(*) AS last_number, count(*) AS n_numbers,
       count(*) AS n_offsets, count(DISTINCT event_id) AS n_ids, 0 AS n_elsewhere FROM events""", ["FAN-7", "FAN-11"])
def feed_stream_numbers(spark, sf_dir):
    """The producer as a stream over documents that land in three parts, a run after each on one
    checkpoint: running numbers 1 to n, and message n at offset n - 1 of the topic's one partition."""
    docs = fx.feed_documents(spark, sf_dir)
    sink = new_topic(spark, "stream-feed", "feed")
    landed, ckpt, sent = (scratch_path(spark, f"feed-{x}") for x in ("landed", "ckpt", "sent"))
    low, high = (f(F.to_date("ts")) for f in (F.min, F.max))
    start, end = table(spark, sf_dir, "events").select(low, high).first()
    for i in range(3):
        docs.filter(F.col("page") % 3 == i).select("value").write.mode("append").option("maxRecordsPerFile", 1).text(landed)
        query = feed_to_topic_stream(spark, landed, str(start), str(end), sink, ckpt, trigger=AVAILABLE_NOW,
                                     num_partitions=1, sent_path=sent)
        run_available_now([query])
    numbers = spark.read.parquet(sent)
    recs = read_topic(spark, TopicSource(kind=FILES, path=sink.path)).select(
        "offset", F.get_json_object(F.col("value").cast("string"), "$.event_id").cast("long").alias("event_id"))
    both = numbers.join(recs, F.col("number") == F.col("offset") + 1, "full")
    return both.agg(F.count(F.lit(1)).alias("n_messages"), F.min("number").alias("first_number"),
                    F.max("number").alias("last_number"), F.count_distinct("number").alias("n_numbers"),
                    F.count_distinct("offset").alias("n_offsets"), F.count_distinct("event_id").alias("n_ids"),
                    F.count_if(F.col("number").isNull() | F.col("offset").isNull()).cast("int").alias("n_elsewhere"))
