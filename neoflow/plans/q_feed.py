"""Feed fan-out queries (SRC-1, FAN-*): the feed documents are built from
``events`` (pages of consecutive event ids, see fixtures), landed as one file
per document, then fanned out again by the job under test."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from neoflow.fs import path_exists
from neoflow.functions.dates import parse_day
from neoflow.operators.feed import (calendar_between, fan_out, first_numbers, missing_days,
                                    parse_feed, serialize, stamp_typed)
from neoflow.plans import fixtures as fx
from neoflow.plans.registry import register, register_subset
from neoflow.plans.tables import table
from neoflow.session import scratch_path
from neoflow.sinks.topic import FILES, TopicSink, create_topic
from neoflow.sources.feed import read_feed_documents, read_feed_lines
from neoflow.sources.topic import TopicSource, read_topic
from neoflow.streaming.feed_job import feed_to_topic

_CACHE: dict[tuple, str] = {}

OBJECT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()), T.StructField("current_date", T.StringType())])


def landed_feed(spark: SparkSession, sf_dir: str) -> str:
    """Feed documents landed as JSON Lines (one document per line)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    path = _CACHE.get(key)
    if path and path_exists(spark, path):
        return path
    path = scratch_path(spark, "feed")
    docs = fx.feed_documents(spark, sf_dir)
    docs.select("value").write.text(path)
    _CACHE[key] = path
    return path


def _docs(spark, sf_dir) -> DataFrame:
    return read_feed_lines(spark, landed_feed(spark, sf_dir))


def _doc_days(spark, sf_dir) -> DataFrame:
    """(page, day_str, objects) - the page number comes from the document."""
    return parse_feed(_docs(spark, sf_dir), doc_fields=[("page", T.LongType())])


def _bounds(spark, sf_dir, pad_before: int = 0, pad_after: int = 0):
    """Start / end day of ``events``: one scalar subquery (one pass over
    ``ts``), its two fields used as Columns."""
    e = table(spark, sf_dir, "events")
    b = e.select(F.struct(F.date_sub(F.min(F.to_date("ts")), pad_before).alias("start"),
                          F.date_add(F.max(F.to_date("ts")), pad_after).alias("end"))).scalar()
    return b.getField("start"), b.getField("end")


def _messages(spark, sf_dir, numbered: bool = False) -> DataFrame:
    start, end = _bounds(spark, sf_dir)
    doc_days = _doc_days(spark, sf_dir)
    msgs = fan_out(doc_days, start, end, key_cols=["page"])
    if numbered:
        msgs = fan_out(doc_days, start, end, key_cols=["page"],
                       starts=first_numbers(doc_days, start, end, "page"))
    return msgs


CAL_SQL = """
SELECT CAST(d AS DATE) AS day, strftime(d, '%Y-%m-%d') AS day_str
FROM (SELECT unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS d
      FROM events) g"""


@register("feed_calendar", CAL_SQL, ["FAN-1", "FAN-2"])
def feed_calendar(spark, sf_dir):
    """Every day between the first and last event day, inclusive."""
    e = table(spark, sf_dir, "events")
    bounds = e.agg(F.min(F.to_date("ts")).alias("start"), F.max(F.to_date("ts")).alias("end"))
    return calendar_between(bounds)


MISSING_SQL = """
SELECT CAST(d AS DATE) AS day, strftime(d, '%Y-%m-%d') AS day_str
FROM (SELECT unnest(generate_series(CAST(min(ts) AS DATE) - 3, CAST(max(ts) AS DATE) + 2, INTERVAL 1 DAY)) AS d
      FROM events) g
WHERE strftime(d, '%Y-%m-%d') NOT IN (SELECT DISTINCT strftime(ts, '%Y-%m-%d') FROM events)"""


@register("feed_missing_days", MISSING_SQL, ["FAN-4"])
def feed_missing_days(spark, sf_dir):
    """Lenient lookup: the days of a wider range that no document has."""
    start, end = _bounds(spark, sf_dir, 3, 2)
    return missing_days(spark, _doc_days(spark, sf_dir), start, end)


FAN_OUT_SQL = """
SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') AS "current_date"
FROM events"""


@register("feed_fan_out", FAN_OUT_SQL, ["SRC-1", "FAN-3", "FAN-5", "FAN-6"])
def feed_fan_out(spark, sf_dir):
    """Landed documents -> one message per object, stamped with its day;
    the messages parsed back."""
    msgs = _messages(spark, sf_dir)
    return msgs.select(F.from_json("value", OBJECT_SCHEMA).alias("m")).select("m.*")


NUMBERING_SQL = """
SELECT event_id, row_number() OVER (ORDER BY strftime(ts, '%Y-%m-%d'), event_id) AS number
FROM events"""


@register("feed_numbering", NUMBERING_SQL, ["FAN-7"])
def feed_numbering(spark, sf_dir):
    """Running message number over the whole run, day then array order."""
    msgs = _messages(spark, sf_dir, numbered=True)
    return msgs.select(F.get_json_object("object", "$.event_id").cast("long").alias("event_id"),
                       "number")


FEED_TOPIC_SQL = """
SELECT strftime(ts, '%Y-%m-%d') AS "current_date", count(*) AS n_messages,
       count(DISTINCT event_id) AS n_ids, sum(user_id)::BIGINT AS users, min(props) AS first_props,
       max(props) AS last_props, sum(length(props))::BIGINT AS props_chars
FROM events GROUP BY 1"""


def _feed_topic(spark, sf_dir) -> str:
    sink = TopicSink(kind=FILES, path=scratch_path(spark, "topic-feed"), topic="feed")
    create_topic(spark, sink)
    start, end = _bounds(spark, sf_dir)
    feed_to_topic(spark, _docs(spark, sf_dir), start, end, sink, doc_col="page",
                  doc_fields=[("page", T.LongType())])
    return sink.path


@register("feed_to_topic", FEED_TOPIC_SQL, ["FAN-9", "FAN-10", "FAN-11", "SNK-3"])
def feed_to_topic_query(spark, sf_dir):
    """The whole producer job into a topic, then the topic read back."""
    recs = read_topic(spark, TopicSource(kind=FILES, path=_feed_topic(spark, sf_dir)))
    m = recs.select(F.from_json(F.col("value").cast("string"), OBJECT_SCHEMA).alias("m"))
    return m.groupBy(F.col("m.current_date").alias("current_date")).agg(
        F.count(F.lit(1)).alias("n_messages"), F.count_distinct("m.event_id").alias("n_ids"),
        F.sum("m.user_id").alias("users"), F.min("m.props").alias("first_props"),
        F.max("m.props").alias("last_props"), F.sum(F.length("m.props")).alias("props_chars"))


@register("feed_emission_order", """
SELECT event_id, number, true AS in_order FROM (
  SELECT event_id, row_number() OVER (ORDER BY strftime(ts, '%Y-%m-%d'), event_id) AS number FROM events) n""",
          ["FAN-8"])
def feed_emission_order(spark, sf_dir):
    """The place of each message in the whole topic (partitions in order, offsets
    within) against the global order; ``in_order``: its offset follows the one before."""
    recs = read_topic(spark, TopicSource(kind=FILES, path=_feed_topic(spark, sf_dir)))
    m = recs.select("partition", "offset",
                    F.get_json_object(F.col("value").cast("string"), "$.event_id").cast("long").alias("event_id"))
    sizes = m.groupBy("partition").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("partition", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    w = Window.partitionBy("partition").orderBy("offset")
    place = m.withColumns({"row": F.row_number().over(w), "prev": F.lag("offset").over(w)})
    return place.join(first, "partition").select(
        "event_id", (F.col("base") + F.col("row")).alias("number"),
        F.coalesce(F.col("prev") < F.col("offset"), F.lit(True)).alias("in_order"))


@register("feed_exact_semantics", """
SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS "current_date", 1 AS n_current_date, 'kept' AS twin
FROM events""", ["FAN-2", "FAN-4", "FAN-5", "FAN-6"])
def feed_exact_semantics(spark, sf_dir):
    """Documents of one event each that also hold a key which isn't quite a day, an
    earlier entry of the same day, and objects with an old ``current_date``; bounds
    with one-digit months and days."""
    e = table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyy-MM-dd")
    obj = lambda **more: F.to_json(F.struct("event_id", F.lit("1999-01-01").alias("current_date"), "event_type",
                                            *(v.alias(k) for k, v in more.items())))
    entry = lambda key, text: F.concat(F.lit('"'), key, F.lit('":['), text, F.lit("]"))
    docs = e.select("event_id", F.concat(
        F.lit('{"near_earth_objects":{'), entry(day, obj(twin=F.lit("first"))), F.lit(","),
        entry(F.concat(day, F.lit("T00")), obj(twin=F.lit("no day"))), F.lit(","),
        entry(day, obj(twin=F.lit("kept"))), F.lit("}}")).alias("value"))
    b = e.select(F.struct(F.date_format(F.min("ts"), "yyyy-M-d").alias("start"),
                          F.date_format(F.max("ts"), "yyyy-M-d").alias("end"))).scalar()
    msgs = fan_out(parse_feed(docs, key_cols=["event_id"]).withColumnRenamed("event_id", "doc"),
                   parse_day(b.getField("start")), parse_day(b.getField("end")), key_cols=["doc"])
    text = F.col("value")
    return msgs.select(
        F.get_json_object(text, "$.event_id").cast("long").alias("event_id"),
        F.get_json_object(text, "$.event_type").alias("event_type"),
        F.get_json_object(text, "$.current_date").alias("current_date"),
        (F.size(F.split(text, '"current_date"')) - 1).alias("n_current_date"),
        F.get_json_object(text, "$.twin").alias("twin"))


@register("feed_typed_route", FAN_OUT_SQL, ["FAN-6", "FAN-9"])
def feed_typed_route(spark, sf_dir):
    """Typed stamp + serialisation: parse each object, set current_date with
    ``withField``, write JSON keeping nulls, parse again."""
    start, end = _bounds(spark, sf_dir)
    objs = fan_out(_doc_days(spark, sf_dir), start, end, key_cols=["page"])
    typed = objs.select(F.from_json("object", OBJECT_SCHEMA).alias("o"), "day_str")
    text = typed.select(serialize(stamp_typed(F.col("o"), F.col("day_str"))).alias("value"))
    return text.select(F.from_json("value", OBJECT_SCHEMA).alias("m")).select("m.*")


# ---------------------------------------------------------------- per id

register_subset("fan_01_calendar", "feed_calendar", ["day"], ["FAN-1"])
register_subset("fan_02_day_format", "feed_calendar", ["day", "day_str"], ["FAN-2"])
register_subset("fan_03_pick_member", "feed_fan_out", ["event_id", "props"], ["FAN-3"])
register_subset("fan_04_day_lookup", "feed_missing_days", ["day_str"], ["FAN-4"])
register_subset("fan_05_flatten_map", "feed_fan_out", ["event_id", "event_type", "value"], ["FAN-5"])
register_subset("fan_06_stamp_day", "feed_fan_out", ["event_id", "current_date"], ["FAN-6"])
register_subset("fan_07_numbering", "feed_numbering", ["event_id", "number"], ["FAN-7"])
register_subset("fan_08_emission_order", "feed_emission_order", ["event_id", "number", "in_order"], ["FAN-8"])
register_subset("fan_09_serialize", "feed_typed_route", ["event_id", "user_id", "props", "current_date"],
                ["FAN-9"])
register_subset("fan_10_encode", "feed_to_topic", ["current_date", "n_messages"], ["FAN-10"])
register_subset("fan_11_feed_to_topic", "feed_to_topic", ["current_date", "n_messages", "n_ids"],
                ["FAN-11"])

@register("src_01_feed_scan", FAN_OUT_SQL, ["SRC-1"])
def src_01_feed_scan(spark, sf_dir):
    """Whole-file documents, one file each, read with their path as the key."""
    path = scratch_path(spark, "feed-files")
    fx.feed_documents(spark, sf_dir).write.partitionBy("page").text(path)
    start, end = _bounds(spark, sf_dir)
    days = parse_feed(read_feed_documents(spark, path), key_cols=["doc_path"])
    msgs = fan_out(days, start, end, key_cols=["doc_path"])
    return msgs.select(F.from_json("value", OBJECT_SCHEMA).alias("m")).select("m.*")
