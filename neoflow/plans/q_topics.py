"""Record-table queries (TOP-*) on ``events`` as a record table
(topic = event_type, partition = user_id mod 3, offset = event_id,
key = user_id, value = props, timestamp = ts)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from neoflow.operators.topics import (envelope_decode, envelope_encode, latest_per_key,
                                      lines_to_records, mirror, offset_ranges, records_to_lines,
                                      retention)
from neoflow.plans import fixtures as fx
from neoflow.plans.registry import register, register_subset
from neoflow.plans.tables import table
from neoflow.session import scratch_path
from neoflow.sinks.topic import FILES, TopicSink, write_topic

RECORDS_CTE = """WITH r AS (
  SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", event_id AS "offset",
         CAST(user_id AS VARCHAR) AS key, props AS value, ts AS "timestamp"
  FROM events)"""


def _records(spark, sf_dir):
    return fx.event_records(spark, sf_dir)


def _strings(df):
    """Bytes columns as text, for comparison."""
    out = df
    for c in ("key", "value"):
        if c in df.columns:
            out = out.withColumn(c, F.col(c).cast("string"))
    return out


@register("lines_to_records", "SELECT 'lines' AS topic, props AS value FROM events", ["TOP-1"])
def lines_to_records_query(spark, sf_dir):
    """events.props written as text lines, read back as lines, each line
    one keyless record of topic 'lines' (written to a file-backed topic)."""
    lines_dir = scratch_path(spark, "lines")
    table(spark, sf_dir, "events").select("props").write.text(lines_dir)
    recs = lines_to_records(spark.read.text(lines_dir), "lines")
    sink = TopicSink(kind=FILES, path=scratch_path(spark, "topic-lines"), topic="lines")
    write_topic(recs, sink)
    back = spark.read.parquet(sink.path)
    return back.select("topic", F.col("value").cast("string").alias("value"))


TOPICS_OUT = ["click", "view"]


@register("records_to_lines",
          "SELECT props AS value FROM events WHERE event_type IN ('click', 'view')", ["TOP-2"])
def records_to_lines_query(spark, sf_dir):
    """Values of the chosen topics written as text lines, read back."""
    out = scratch_path(spark, "lines-out")
    records_to_lines(_records(spark, sf_dir), TOPICS_OUT).write.text(out)
    return spark.read.text(out)


PROPS_TYPE = T.StructType([T.StructField("k", T.LongType(), True)])


@register("json_envelope",
          """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
                    'struct' AS schema_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k_bare
             FROM events""", ["TOP-3"])
def json_envelope(spark, sf_dir):
    """props -> struct -> envelope with schema -> decoded payload; and the
    schemaless (bare payload) round trip."""
    e = table(spark, sf_dir, "events").select("event_id", F.from_json("props", PROPS_TYPE).alias("p"))
    env = e.select("event_id", "p", envelope_encode(F.col("p"), PROPS_TYPE).alias("env"),
                   envelope_encode(F.col("p"), PROPS_TYPE, schemas_enable=False).alias("bare"))
    return env.select(
        "event_id",
        envelope_decode(F.col("env"), PROPS_TYPE).getField("k").alias("k"),
        F.get_json_object("env", "$.schema.type").alias("schema_type"),
        envelope_decode(F.col("bare"), PROPS_TYPE, schemas_enable=False).getField("k").alias("k_bare"))


MIRROR_PATTERN = "click|view|sign.*"


@register("topic_mirror", RECORDS_CTE + f"""
SELECT 'A.' || topic AS topic, "partition", "offset", key, value FROM r
WHERE regexp_full_match(topic, '{MIRROR_PATTERN}')""", ["TOP-4"])
def topic_mirror(spark, sf_dir):
    """Cluster A holds its own topics and, from an earlier B -> A flow, the
    same events as 'B.<topic>'. Mirroring A -> B sends only A's own matching
    topics, renamed 'A.<topic>'."""
    own = _records(spark, sf_dir)
    from_b = mirror(own, "B", "A")  # what B -> A put into A earlier
    a = own.unionByName(from_b)
    return _strings(mirror(a, "A", "B", MIRROR_PATTERN)).select("topic", "partition", "offset",
                                                                 "key", "value")


@register("offset_ranges", RECORDS_CTE + """
SELECT topic, "partition", min("offset") AS first_offset, max("offset") AS last_offset,
       max("offset") + 1 AS next_offset, count(*) AS n_records
FROM r GROUP BY topic, "partition\"""", ["TOP-5"])
def offset_ranges_query(spark, sf_dir):
    return offset_ranges(_records(spark, sf_dir))


RETENTION_HOURS = 168


@register("retention", RECORDS_CTE + f"""
SELECT topic, "partition", "offset", key, value FROM r
WHERE "timestamp" >= (SELECT max("timestamp") FROM r) - INTERVAL {RETENTION_HOURS} HOUR""", ["TOP-6"])
def retention_query(spark, sf_dir):
    """Records younger than 168 h at the newest record's time."""
    kept = retention(_records(spark, sf_dir), RETENTION_HOURS)
    return _strings(kept).select("topic", "partition", "offset", "key", "value")


@register("latest_per_key", RECORDS_CTE + """
SELECT topic, "partition", key, max("offset") AS "offset", arg_max(value, "offset") AS value
FROM r WHERE key IS NOT NULL GROUP BY topic, "partition", key""", ["TOP-7"])
def latest_per_key_query(spark, sf_dir):
    return _strings(latest_per_key(_records(spark, sf_dir))).select(
        "topic", "partition", "key", "offset", "value")


register_subset("top_01_lines_to_records", "lines_to_records", ["topic", "value"], ["TOP-1"])
register_subset("top_02_records_to_lines", "records_to_lines", ["value"], ["TOP-2"])
register_subset("top_03_json_envelope", "json_envelope", ["event_id", "k", "schema_type"], ["TOP-3"])
register_subset("top_04_topic_mirror", "topic_mirror", ["topic", "partition", "offset"], ["TOP-4"])
register_subset("top_05_offset_ranges", "offset_ranges",
                ["topic", "partition", "first_offset", "last_offset", "n_records"], ["TOP-5"])
register_subset("top_06_retention", "retention", ["topic", "partition", "offset"], ["TOP-6"])
register_subset("top_07_latest_per_key", "latest_per_key", ["topic", "partition", "key", "offset"],
                ["TOP-7"])
