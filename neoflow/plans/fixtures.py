"""Inputs built from the driver's tables with Spark expressions.

* payload messages: one JSON message per row of ``orders LEFT JOIN lineitem``
  (an order without lines gives one message with an empty approach array).
  Each message is bounded in size: the approach array holds the line's own
  approach and a second "echo" approach that the flatten must ignore.
* payload records: those messages as a record table (file-backed topic).
* event records: ``events`` as a record table: topic = event_type,
  partition = user_id mod 3, offset = event_id (increasing within each
  partition, with gaps, as offsets may have), key = user_id, value = props.
* feed documents: ``events`` grouped into pages of at most PAGE_SIZE objects
  (consecutive event ids), each page one document
  ``{"page": n, "near_earth_objects": {day: [object, ...]}}``. Pages bound
  every group by construction, so no day - however hot - is collected into
  one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from neoflow.functions.dates import format_day
from neoflow.functions.json import encode_utf8, to_json_keep_nulls
from neoflow.plans.tables import table
from neoflow.schemas import RECORD_COLUMNS

PAYLOAD_TOPIC = "objects"
PAGE_SIZE = 500
# Fixed value: timestampType of records stamped at creation time.
CREATE_TIME = 0


def _s(c) -> Column:
    return F.col(c).cast("string")


def _approach(day_ts: Column, kps: Column, kph: Column, au: Column, lunar: Column,
              km: Column, miles: Column) -> Column:
    return F.struct(
        format_day(day_ts).alias("close_approach_date"),
        F.date_format(day_ts, "yyyy-MM-dd HH:mm").alias("close_approach_date_full"),
        F.unix_millis(day_ts.cast("timestamp")).alias("epoch_date_close_approach"),
        F.struct(kps.cast("string").alias("kilometers_per_second"),
                 kph.cast("string").alias("kilometers_per_hour"),
                 (kph * F.lit(0.621371)).cast("string").alias("miles_per_hour")).alias("relative_velocity"),
        F.struct(au.cast("string").alias("astronomical"),
                 lunar.cast("string").alias("lunar"),
                 km.cast("string").alias("kilometers"),
                 miles.cast("string").alias("miles")).alias("miss_distance"),
        F.lit("Earth").alias("orbiting_body"),  # unknown to the consumer schema
    )


def _diam(lo: Column, hi: Column, factor: float) -> Column:
    return F.struct((lo * F.lit(factor)).alias("estimated_diameter_min"),
                    (hi * F.lit(factor)).alias("estimated_diameter_max"))


def payload_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One narrow row per message: the columns of its order and line."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    # Merged, not broadcast: the wide messages are made in the join's tasks, however few the scans have.
    return o.join(li.hint("merge"), o.o_orderkey == li.l_orderkey, "left")


def objects_of(lines: DataFrame) -> DataFrame:
    """``payload_lines`` -> one row per message with the object struct in ``obj`` plus the order
    key, line number and order date (for record timestamps)."""
    ship = F.col("l_shipdate")
    line = _approach(ship, F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount"),
                     F.col("l_tax"), F.col("l_partkey"), F.col("l_suppkey"))
    echo = _approach(F.date_add(ship, 30), F.col("l_tax"), F.col("l_quantity"), F.col("l_tax"),
                     F.col("l_discount"), F.col("l_suppkey"), F.col("l_partkey"))
    # An order without lines gets an empty (typed) approach array.
    none = F.filter(F.array(line), lambda x: F.lit(False))
    obj = F.struct(
        F.struct(F.concat(F.lit("urn:order:"), _s("o_orderkey")).alias("self")).alias("links"),
        _s("o_orderkey").alias("id"),
        _s("o_custkey").alias("neo_reference_id"),
        F.concat(F.lit("("), _s("o_orderkey"), F.lit(") "), F.col("o_orderpriority")).alias("name"),
        F.concat(F.lit("urn:cust:"), _s("o_custkey")).alias("nasa_jpl_url"),
        F.col("o_totalprice").alias("absolute_magnitude_h"),
        F.struct(_diam(F.col("o_totalprice"), F.col("o_custkey").cast("double"), 1.0).alias("kilometers"),
                 _diam(F.col("o_totalprice"), F.col("o_custkey").cast("double"), 1000.0).alias("meters"),
                 _diam(F.col("o_totalprice"), F.col("o_custkey").cast("double"), 0.621371).alias("miles"),
                 _diam(F.col("o_totalprice"), F.col("o_custkey").cast("double"), 3280.84).alias("feet"),
                 ).alias("estimated_diameter"),
        (F.col("o_orderstatus") == "F").alias("is_potentially_hazardous_asteroid"),
        F.when(F.col("l_orderkey").isNull(), none)
         .otherwise(F.array(line, echo)).alias("close_approach_data"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_sentry_object"),
        format_day("o_orderdate").alias("current_date"),
    )
    return lines.select("o_orderkey", "l_linenumber", "o_orderdate", obj.alias("obj"))


def payload_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects_of(payload_lines(spark, sf_dir))


def messages_of(lines: DataFrame) -> DataFrame:
    """(value: JSON text, ts) per message, nulls written as ``null``."""
    return objects_of(lines).select(
        to_json_keep_nulls("obj").alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("ts"))


def payload_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_of(payload_lines(spark, sf_dir))


def as_records(messages: DataFrame, topic: str, value_col: str = "value",
               ts_col: str | None = "ts", key: Column | None = None) -> DataFrame:
    """Text messages -> record table. Records are numbered per Spark
    partition, which stands for the topic partition: offsets are dense and
    increasing within a partition, and no shuffle is needed."""
    pid = F.spark_partition_id()
    return messages.select(
        (key if key is not None else F.lit(None)).cast("binary").alias("key"),
        encode_utf8(value_col).alias("value"),
        F.lit(topic).alias("topic"),
        pid.alias("partition"),
        (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias("offset"),
        (F.col(ts_col).cast("timestamp") if ts_col else F.current_timestamp()).alias("timestamp"),
        F.lit(CREATE_TIME).alias("timestampType"),
    ).select(*RECORD_COLUMNS)


def payload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_records(payload_messages(spark, sf_dir), PAYLOAD_TOPIC)


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a record table (see module doc)."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    return e.select(
        encode_utf8(_s("user_id")).alias("key"),
        encode_utf8("props").alias("value"),
        F.col("event_type").alias("topic"),
        F.pmod(F.col("user_id"), F.lit(3)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(CREATE_TIME).alias("timestampType"),
    )


def event_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed objects from ``events``: (page, day, event_id, obj struct)."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    return e.select(
        F.floor(F.col("event_id") / F.lit(PAGE_SIZE)).alias("page"),
        format_day("ts").alias("day"),
        "event_id",
        F.struct("event_id", "user_id", "event_type", "value", "props").alias("obj"),
    )


def feed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page, value) with value = one feed document per page, as JSON text
    ``{"page": n, "near_earth_objects": {...}}`` (a paged API's response).

    Two bounded aggregations: objects per (page, day), then days per page.
    Both groups hold at most PAGE_SIZE objects when event ids are unique."""
    objs = event_objects(spark, sf_dir)
    per_day = objs.groupBy("page", "day").agg(
        F.array_sort(F.collect_list(F.struct("event_id", "obj"))).alias("items"))
    per_day = per_day.select("page", "day", F.transform("items", lambda x: x["obj"]).alias("objs"))
    docs = per_day.groupBy("page").agg(
        F.map_from_entries(F.collect_list(F.struct("day", "objs"))).alias("near_earth_objects"))
    return docs.select("page", to_json_keep_nulls(F.struct("page", "near_earth_objects")).alias("value"))
