"""Record-table jobs: what the broker distribution's connectors and tools
do to topic data, written as Spark DataFrame jobs over a record table
(key, value, topic, partition, offset, timestamp, timestampType), batch or
streaming unless noted.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from neoflow.functions.json import encode_utf8

# ----------------------------------------------------------------- TOP-1/2


def lines_to_records(lines: DataFrame, topic: str, line_col: str = "value") -> DataFrame:
    """Each text line -> one keyless record of ``topic`` (value = UTF-8 bytes)."""
    return lines.select(F.lit(None).cast("binary").alias("key"),
                        encode_utf8(line_col).alias("value"),
                        F.lit(topic).alias("topic"))


def records_to_lines(records: DataFrame, topics: list[str]) -> DataFrame:
    """Values of the chosen topics as text lines (``value`` string)."""
    return records.filter(F.col("topic").isin(list(topics))) \
        .select(F.col("value").cast("string").alias("value"))


def lines_to_topic_stream(spark, lines_dir: str, topic: str, sink, checkpoint: str,
                          trigger: dict | None = None):
    """Streaming file-source connector: new text files in ``lines_dir`` ->
    one record per line into the topic sink."""
    from neoflow.sinks.topic import write_topic_stream
    lines = spark.readStream.text(lines_dir)
    return write_topic_stream(lines_to_records(lines, topic), sink, checkpoint, trigger)


def topic_to_lines_stream(records: DataFrame, topics: list[str], out_dir: str, checkpoint: str,
                          trigger: dict | None = None):
    """Streaming file-sink connector: values of the chosen topics appended
    as text lines (exactly-once file sink)."""
    w = records_to_lines(records, topics).writeStream.format("text").outputMode("append") \
        .option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start(out_dir)


# ------------------------------------------------------------------- TOP-3
# The type names of the JSON converter's schema envelope.
_CONNECT_TYPES = [
    (T.ByteType, "int8"), (T.ShortType, "int16"), (T.IntegerType, "int32"),
    (T.LongType, "int64"), (T.FloatType, "float32"), (T.DoubleType, "float64"),
    (T.BooleanType, "boolean"), (T.StringType, "string"), (T.BinaryType, "bytes"),
]

# Logical types, by the type that carries them.
_LOGICAL_TYPES = [
    (T.DateType, "int32", "org.apache.kafka.connect.data.Date"),
    (T.TimestampType, "int64", "org.apache.kafka.connect.data.Timestamp"),
    (T.DecimalType, "bytes", "org.apache.kafka.connect.data.Decimal"),
]


def connect_schema(dtype: T.DataType, nullable: bool = True, name: str | None = None, logical: bool = False) -> dict:
    """Spark type -> JSON converter schema object (built once on the driver
    from the schema, never from data). Dates, timestamps and decimals need ``logical``
    (see ``operators.envelope``)."""
    out: dict | None = None
    for cls, tname, lname in _LOGICAL_TYPES if logical else ():
        if isinstance(dtype, cls):
            out = {"type": tname, "name": lname, "version": 1}
            if isinstance(dtype, T.DecimalType):
                out["parameters"] = {"scale": str(dtype.scale)}
    for cls, tname in _CONNECT_TYPES if out is None else ():
        if isinstance(dtype, cls):
            out = {"type": tname}
    if out is None:
        if isinstance(dtype, T.StructType):
            out = {"type": "struct",
                   "fields": [connect_schema(f.dataType, f.nullable, f.name, logical) for f in dtype.fields]}
        elif isinstance(dtype, T.ArrayType):
            out = {"type": "array", "items": connect_schema(dtype.elementType, dtype.containsNull, None, logical)}
        elif isinstance(dtype, T.MapType):
            out = {"type": "map", "keys": connect_schema(dtype.keyType, False, None, logical),
                   "values": connect_schema(dtype.valueType, dtype.valueContainsNull, None, logical)}
        else:
            raise TypeError(f"no envelope type for {dtype.simpleString()}")
    out["optional"] = bool(nullable)
    if name is not None:
        out["field"] = name
    return out


def json_value(c: Column) -> Column:
    """JSON text of any value: serialise {"p": c} and cut the member out."""
    t = F.to_json(F.struct(c.alias("p")), {"ignoreNullFields": "false"})
    return F.substring(t, F.lit(6), F.length(t) - 6)


def envelope_encode(c: Column, dtype: T.DataType, schemas_enable: bool = True) -> Column:
    """Value -> converter JSON text: ``{"schema": .., "payload": ..}`` with
    schemas on, the bare payload with schemas off."""
    payload = json_value(c)
    payload = F.coalesce(payload, F.lit("null"))
    if not schemas_enable:
        return payload
    schema_txt = json.dumps(connect_schema(dtype), separators=(",", ":"))
    return F.concat(F.lit('{"schema":' + schema_txt + ',"payload":'), payload, F.lit("}"))


def envelope_decode(text: Column, dtype: T.DataType, schemas_enable: bool = True) -> Column:
    """Converter JSON text -> value of ``dtype`` (the payload)."""
    if schemas_enable:
        env = T.StructType([T.StructField("payload", dtype, True)])
        return F.from_json(text, env).getField("payload")
    wrapped = F.concat(F.lit('{"p":'), text, F.lit("}"))
    return F.from_json(wrapped, T.StructType([T.StructField("p", dtype, True)])).getField("p")


# ------------------------------------------------------------------- TOP-4

def mirror(records: DataFrame, source_alias: str, target_alias: str, pattern: str = ".*",
           separator: str = ".") -> DataFrame:
    """Records of cluster ``source_alias`` to send to ``target_alias``:
    topics matching ``pattern`` (whole name), renamed
    ``<source_alias><sep><topic>``; a topic that came from the target
    (``<target_alias><sep>...``) is not sent back. Partition, key, value and
    timestamp are kept; the target assigns new offsets."""
    t = F.col("topic")
    keep = t.rlike(f"^(?:{pattern})$") & ~t.startswith(target_alias + separator)
    return records.filter(keep).withColumn("topic", F.concat(F.lit(source_alias + separator), t))


def mirror_both(a: DataFrame, b: DataFrame, alias_a: str, alias_b: str, pattern: str = ".*",
                separator: str = ".") -> tuple[DataFrame, DataFrame]:
    """Both flows of an active-active pair: (records to append to B,
    records to append to A). Each side's copies of the other's topics are
    not sent back, so a topic never loops."""
    return (mirror(a, alias_a, alias_b, pattern, separator),
            mirror(b, alias_b, alias_a, pattern, separator))


# ------------------------------------------------------------------- TOP-5

def offset_ranges(records: DataFrame) -> DataFrame:
    """Per (topic, partition): first, last and next offset and the record
    count (offsets may have gaps, so count <= last - first + 1). One hash
    aggregate with map-side partial aggregation."""
    return records.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        (F.max("offset") + 1).alias("next_offset"),
        F.count(F.lit(1)).alias("n_records"))


# ------------------------------------------------------------------- TOP-6

def retention(records: DataFrame, hours: int = 168, asof: Column | str | None = None) -> DataFrame:
    """Records younger than ``hours`` at ``asof`` (a timestamp literal or
    Column; default: the newest record's timestamp, as a scalar subquery).
    A plain filter: pushed into the scan for file-backed topics."""
    if asof is None:
        asof_c = records.select(F.max("timestamp")).scalar()
    elif isinstance(asof, str):
        asof_c = F.lit(asof).cast("timestamp")
    else:
        asof_c = asof
    return records.filter(F.col("timestamp") >= asof_c - F.make_interval(hours=F.lit(hours)))


# ------------------------------------------------------------------- TOP-7

def latest_per_key(records: DataFrame) -> DataFrame:
    """What a reader of a compacted topic sees: per (topic, partition, key)
    the record with the highest offset; a NULL value (tombstone) deletes the
    key. Records without a key are not compacted and are dropped.

    ``max_by`` is a partial aggregate: a hot key is reduced map-side to one
    row per task before the shuffle."""
    keyed = records.filter(F.col("key").isNotNull())
    last = keyed.groupBy("topic", "partition", "key").agg(
        F.max_by(F.struct("offset", "value", "timestamp"), F.col("offset")).alias("r"))
    return last.filter(F.col("r.value").isNotNull()).select(
        "topic", "partition", "key", F.col("r.offset").alias("offset"),
        F.col("r.value").alias("value"), F.col("r.timestamp").alias("timestamp"))
