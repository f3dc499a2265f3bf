"""Feed fan-out: dated feed documents -> one JSON message per object.

    documents (one row each: text + a document key)
      -> from_json(near_earth_objects: map<day, array<raw object text>>)
      -> last entry of each key -> explode -> keep days in [start, end]
      -> first message number of each (day, document) -> posexplode(array)
      -> stamp "current_date" into the raw object text
      -> bytes -> topic

Objects stay raw JSON text all the way, so unknown fields, nested values and
explicit nulls reach the message unchanged. Everything runs on executors;
the only small tables are the calendar (one row per day) and the per-day /
per-document counts used for numbering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from neoflow.functions.dates import day_calendar, exact_day, format_day, parse_day
from neoflow.functions.json import encode_utf8, stamp_field_raw
from neoflow.schemas import FEED_MEMBER, FEED_SCHEMA
from neoflow.session import scratch_path

STAMP_FIELD = "current_date"


def _lit_date(d) -> Column:
    return d if isinstance(d, Column) else parse_day(F.lit(d))


def in_days(start, end, day_col: str = "day_str") -> Column:
    """The key is a day of [start, end], written exactly 'yyyy-MM-dd'."""
    return F.coalesce(exact_day(day_col).between(_lit_date(start), _lit_date(end)), F.lit(False))


def _last_entries(days: Column) -> Column:
    """The map's entries, of entries with one key the last."""
    keys = F.map_keys(days)
    last = lambda e, i: i == F.size(keys) - F.array_position(F.reverse(keys), e["key"])
    return F.filter(F.map_entries(days), last)


def calendar(spark: SparkSession, start, end) -> DataFrame:
    """(day DATE, day_str) for every day from start to end inclusive; no rows
    when start > end. One row per day: bounded by the date range."""
    one = spark.range(1).select(day_calendar(_lit_date(start), _lit_date(end)).alias("days"))
    return one.select(F.explode("days").alias("day")).select("day", format_day("day").alias("day_str"))


def calendar_between(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """Calendar from a one-row DataFrame of bounds (e.g. an aggregate)."""
    return bounds.select(F.explode(day_calendar(F.col(start_col), F.col(end_col))).alias("day")) \
        .select("day", format_day("day").alias("day_str"))


def parse_feed(docs: DataFrame, text_col: str = "value", key_cols: list[str] | None = None,
               doc_fields: list | None = None) -> DataFrame:
    """Documents -> (key cols..., doc fields..., day_str, objects: array<raw
    text>), one row per (document, day). ``doc_fields`` are top-level members
    of the document itself (e.g. ``[("page", LongType())]``), parsed in the
    same pass. A document without the member gives no rows; of a day key that
    a document repeats the last entry counts."""
    key_cols = key_cols or []
    schema = T.StructType(list(FEED_SCHEMA.fields)
                          + [T.StructField(name, dtype, True) for name, dtype in doc_fields or []])
    parsed = docs.select(*key_cols, F.from_json(F.col(text_col), schema).alias("_doc"))
    extra = [F.col(f"_doc.{name}").alias(name) for name, _ in doc_fields or []]
    entries = parsed.select(*key_cols, *extra, F.explode(_last_entries(F.col(f"_doc.{FEED_MEMBER}"))).alias("_e"))
    return entries.select(*key_cols, *[name for name, _ in doc_fields or []],
                          F.col("_e.key").alias("day_str"), F.col("_e.value").alias("objects"))


def fan_out(doc_days: DataFrame, start, end, key_cols: list[str] | None = None,
            starts: DataFrame | None = None) -> DataFrame:
    """(document, day) rows -> one row per object of the days in [start,
    end]: (key cols..., day_str, pos, object = raw text, value = stamped
    message text). With ``starts`` (from ``first_numbers``) also ``number``: the
    first numbers are joined to the rows before they are exploded, so messages
    don't move. An element that isn't a JSON object fails the job."""
    key_cols = key_cols or []
    days = doc_days.filter(in_days(start, end))
    number = []
    if starts is not None:
        days = days.join(starts, ["day_str", *key_cols])
        number = ["_first"]
    objs = days.select(*key_cols, "day_str", *number, F.posexplode("objects").alias("pos", "object"))
    text = F.trim("object")
    is_object = F.coalesce(text.startswith("{") & text.endswith("}"), F.lit(False))
    checked = F.when(is_object, F.col("object")).otherwise(F.raise_error(F.concat(
        F.lit("a feed element is not a JSON object on day "), F.col("day_str"))))
    out = objs.withColumn("value", stamp_field_raw(checked, STAMP_FIELD, F.col("day_str")))
    return out.withColumn("number", F.col("_first") + F.col("pos")).drop("_first") if number else out


def fan_out_variant(docs: DataFrame, start, end, text_col: str = "value") -> DataFrame:
    """Documents -> (day_str, pos, object, value) of the objects of the days in [start, end], by way of a variant:
    days and then objects are exploded from the parsed document, so no day's list is one value of
    a row. The object's text is written anew (members in the variant's order), where ``fan_out``
    hands the document's own text on; a document that is no JSON gives no rows."""
    day = docs.select(F.try_parse_json(text_col).alias("_doc")).select(
        F.try_variant_get("_doc", f"$.{FEED_MEMBER}", "variant").alias("_days"))
    spark = docs.sparkSession
    days = day.lateralJoin(spark.tvf.variant_explode(F.col("_days").outer()).select(
        F.col("key").alias("day_str"), F.col("value").alias("_objects"))).filter(in_days(start, end))
    objs = days.lateralJoin(spark.tvf.variant_explode(F.col("_objects").outer()).select("pos", F.col("value").alias("_object")))
    out = objs.select("day_str", "pos", F.to_json("_object").alias("object"))
    return out.withColumn("value", stamp_field_raw(F.col("object"), STAMP_FIELD, F.col("day_str")))


def first_numbers(doc_days: DataFrame, start, end, doc_col: str) -> DataFrame:
    """(day_str, doc, _first): the running number (from 1) of each (day, document)'s
    first object, in (day, document) order over the whole run.

    A two-level prefix sum over narrow count rows: they are range-partitioned
    and written with their range, ranges are summed up (one row per range), and
    rows within each range. A hot day is so spread over many ranges."""
    counts = (object_counts(doc_days, start, end, doc_col).repartitionByRange("day_str", doc_col)
              .withColumn("_range", F.spark_partition_id()))
    path = scratch_path(doc_days.sparkSession, "feed-counts")
    counts.write.parquet(path)
    counts = doc_days.sparkSession.read.parquet(path)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (counts.groupBy("_range").agg(F.sum("_n").alias("_r"))
              .select("_range", F.coalesce(F.sum("_r").over(before), F.lit(0)).alias("_base")))
    within = Window.partitionBy("_range").orderBy("day_str", doc_col).rowsBetween(Window.unboundedPreceding, -1)
    own = counts.withColumn("_own", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    return own.join(ranges, "_range").select("day_str", doc_col, (F.col("_base") + F.col("_own") + 1).alias("_first"))


def missing_days(spark: SparkSession, doc_days: DataFrame, start, end) -> DataFrame:
    """Days of the calendar that no document has (the lookup would fail)."""
    cal = calendar(spark, start, end)
    have = doc_days.select("day_str").distinct()
    return cal.join(have, "day_str", "left_anti").select("day", "day_str")


def require_all_days(spark: SparkSession, messages: DataFrame, doc_days: DataFrame, start, end) -> DataFrame:
    """Strict lookup: the result fails at run time (``raise_error``) when a
    calendar day is missing from every document, like a missing dict key."""
    miss = missing_days(spark, doc_days, start, end)
    boom = miss.select(*[
        (F.raise_error(F.concat(F.lit("feed has no objects list for day "), F.col("day_str")))
         .cast(f.dataType).alias(f.name)) if i == 0 else F.lit(None).cast(f.dataType).alias(f.name)
        for i, f in enumerate(messages.schema.fields)])
    return messages.unionByName(boom)


def object_counts(doc_days: DataFrame, start, end, doc_col: str) -> DataFrame:
    """(day_str, doc, n) - objects per (document, day) inside [start, end],
    read off the array sizes: no explode, one small row per (document, day)."""
    return doc_days.filter(in_days(start, end)).groupBy("day_str", doc_col) \
        .agg(F.sum(F.size("objects")).alias("_n"))


def number_messages(msgs: DataFrame, counts: DataFrame, doc_col: str, day_col: str = "day_str",
                    pos_col: str = "pos", out: str = "number") -> DataFrame:
    """1-based running number over the whole run in (day, document, pos)
    order, without a global single-partition window over the messages:

    * ``counts`` (from ``object_counts``) -> start of each document within
      its day (window per day over that day's count rows only);
    * per-day totals -> start of each day (window over one row per day,
      bounded by the calendar);
    * number = day start + document start + pos + 1.

    The start table has one row per (day, document); AQE broadcasts it when
    its measured size is small and falls back to a shuffle join otherwise."""
    w_doc = Window.partitionBy(day_col).orderBy(doc_col).rowsBetween(Window.unboundedPreceding, -1)
    per_doc = counts.withColumn("_doc_start", F.coalesce(F.sum("_n").over(w_doc), F.lit(0)))
    per_day = counts.groupBy(day_col).agg(F.sum("_n").alias("_day_n"))
    w_day = Window.orderBy(day_col).rowsBetween(Window.unboundedPreceding, -1)
    per_day = per_day.withColumn("_day_start", F.coalesce(F.sum("_day_n").over(w_day), F.lit(0)))
    starts = per_doc.join(per_day, day_col).select(
        day_col, doc_col, (F.col("_day_start") + F.col("_doc_start")).alias("_start"))
    j = msgs.join(starts, [day_col, doc_col])
    return j.withColumn(out, F.col("_start") + F.col(pos_col) + F.lit(1)).drop("_start")


def emission_order(msgs: DataFrame, doc_col: str, num_partitions: int | None = None) -> DataFrame:
    """Messages laid out in emission order (day, document, pos): range
    partitions in that order, sorted within each. One partition per topic
    partition keeps per-partition order; the key is unique, so a hot day is
    split across partitions."""
    keys = [F.col("day_str"), F.col(doc_col), F.col("pos")]
    n = num_partitions or int(msgs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return msgs.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def in_emission_order(numbered: DataFrame, total: Column, num_partitions: int, tasks: int | None = None) -> DataFrame:
    """Numbered messages with ``partition``: numbers 1..total cut into
    ``num_partitions`` equal runs, one Spark partition each, sorted by number. Where
    a message goes is arithmetic, so nothing is sampled. With ``tasks`` the numbers are cut into that
    many Spark partitions, in order, whatever the topic partition."""
    cut = lambda n: F.floor((F.col("number") - 1) / F.greatest(F.ceil(total / F.lit(n)), F.lit(1))).cast("int")
    placed = numbered.withColumn("partition", cut(num_partitions))
    if tasks is None:
        return placed.repartitionById(num_partitions, "partition").sortWithinPartitions("number")
    return (placed.withColumn("_part", cut(tasks)).repartitionById(tasks, "_part").sortWithinPartitions("number").drop("_part"))


def to_message_bytes(msgs: DataFrame, value_col: str = "value") -> DataFrame:
    return msgs.withColumn(value_col, encode_utf8(value_col))


def stamp_typed(obj: Column, day: Column) -> Column:
    """Typed route of the stamp: set ``current_date`` on a parsed object
    struct (added last, replaces an existing field)."""
    return obj.withField(STAMP_FIELD, day)


def serialize(obj: Column) -> Column:
    """Object struct -> JSON text with nulls written out."""
    return F.to_json(obj, {"ignoreNullFields": "false"})
