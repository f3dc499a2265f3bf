"""Self-describing messages: JSON envelopes with logical types, decoded by the schema they carry.

Dates are days, timestamps milliseconds and decimals base64 of the unscaled number's
bytes (big-endian, two's complement); the schema names them. Encoding and decoding
are column expressions built from the type; from the data only the distinct
schemas of a topic, a bounded number, come to the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from neoflow.operators.topics import connect_schema, json_value

# The converter's names of logical types.
DATE, TIMESTAMP, DECIMAL = (f"org.apache.kafka.connect.data.{n}" for n in ("Date", "Timestamp", "Decimal"))
_PLAIN = {"int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(),
          "float32": T.FloatType(), "float64": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType(),
          "bytes": T.BinaryType()}
#: Digits of a decimal whose unscaled number fits in 64 bits; what is read back has so many.
DIGITS = 18


def schema_type(schema: dict) -> T.DataType:
    """Converter schema object -> Spark type."""
    kind, name = schema["type"], schema.get("name")
    if name == DATE:
        return T.DateType()
    if name == TIMESTAMP:
        return T.TimestampType()
    if name == DECIMAL:
        return T.DecimalType(DIGITS, int(schema["parameters"]["scale"]))
    if kind == "struct":
        return T.StructType([T.StructField(f["field"], schema_type(f), f.get("optional", True)) for f in schema["fields"]])
    if kind == "array":
        return T.ArrayType(schema_type(schema["items"]), schema["items"].get("optional", True))
    if kind == "map":
        return T.MapType(schema_type(schema["keys"]), schema_type(schema["values"]), schema["values"].get("optional", True))
    if kind not in _PLAIN:
        raise TypeError(f"no Spark type for schema type {kind!r}")
    return _PLAIN[kind]


def wire_type(dtype: T.DataType) -> T.DataType:
    """The type of a value as its JSON holds it."""
    if isinstance(dtype, T.DateType):
        return T.IntegerType()
    if isinstance(dtype, T.TimestampType):
        return T.LongType()
    if isinstance(dtype, (T.DecimalType, T.BinaryType)):
        return T.StringType()
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, wire_type(f.dataType), True) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(wire_type(dtype.elementType), True)
    if isinstance(dtype, T.MapType):
        return T.MapType(T.StringType(), wire_type(dtype.valueType), True)
    return dtype


def _same(dtype: T.DataType) -> bool:
    """No part of the type differs on the wire."""
    return wire_type(dtype) == dtype


def _decimal_bytes(c: Column, dtype: T.DecimalType) -> Column:
    if dtype.precision > DIGITS:
        raise TypeError(f"decimals of over {DIGITS} digits have no envelope: {dtype.simpleString()}")
    unscaled = (c * F.lit(Decimal(10) ** dtype.scale)).cast("decimal(38,0)").cast("long")
    return F.base64(F.unhex(F.lpad(F.hex(unscaled), 16, "0")))


def _bytes_decimal(c: Column, dtype: T.DecimalType) -> Column:
    """Base64 of any number of bytes; over 64 bits' worth of number is null."""
    hexed = F.hex(F.unbase64(c))
    negative = F.substring(hexed, 1, 1) >= "8"
    full = F.when(F.length(hexed) >= 16, hexed).when(negative, F.lpad(hexed, 16, "F")).otherwise(F.lpad(hexed, 16, "0"))
    spare = F.substring(hexed, F.lit(1), F.greatest(F.length(hexed) - 16, F.lit(0)))
    only_sign = F.when(negative, F.regexp_replace(spare, "F", "")).otherwise(F.regexp_replace(spare, "0", "")) == ""
    last = F.substring(full, F.greatest(F.length(full) - 15, F.lit(1)), F.lit(16))
    fits = only_sign & ((F.length(hexed) <= 16) | ((F.substring(last, 1, 1) >= "8") == negative))
    unscaled = F.conv(last, 16, -10).cast("decimal(20,0)")
    return F.when(fits, (unscaled * F.lit(Decimal(1).scaleb(-dtype.scale))).try_cast(dtype))


def to_wire(c: Column, dtype: T.DataType) -> Column:
    """A value as its JSON holds it."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_millis(c)
    if isinstance(dtype, T.DecimalType):
        return _decimal_bytes(c, dtype)
    if isinstance(dtype, T.BinaryType):
        return F.base64(c)
    if _same(dtype):
        return c
    if isinstance(dtype, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(to_wire(c.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields)))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: to_wire(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(F.transform_keys(c, lambda k, v: k.cast("string")), lambda k, v: to_wire(v, dtype.valueType))
    return c


def from_wire(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DateType):
        return F.date_from_unix_date(c)
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_millis(c)
    if isinstance(dtype, T.DecimalType):
        return _bytes_decimal(c, dtype)
    if isinstance(dtype, T.BinaryType):
        return F.unbase64(c)
    if _same(dtype):
        return c
    if isinstance(dtype, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(from_wire(c.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields)))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: from_wire(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(F.transform_keys(c, lambda k, v: k.cast(dtype.keyType)), lambda k, v: from_wire(v, dtype.valueType))
    return c


def describe(c: Column, dtype: T.DataType) -> Column:
    """A value with its schema: the envelope's JSON text."""
    schema = json.dumps(connect_schema(dtype, logical=True), separators=(",", ":"))
    payload = F.coalesce(json_value(to_wire(c, dtype)), F.lit("null"))
    return F.concat(F.lit('{"schema":' + schema + ',"payload":'), payload, F.lit("}"))


def payload(text: Column, dtype: T.DataType) -> Column:
    """The payload of envelope text as a value of ``dtype``."""
    env = T.StructType([T.StructField("payload", wire_type(dtype), True)])
    return from_wire(F.from_json(text, env).getField("payload"), dtype)


def message_schemas(messages: DataFrame, value: str = "value", most: int = 100) -> list[str]:
    """The distinct schema texts of a topic's messages, in order; more than ``most`` fail."""
    schema = F.get_json_object(F.col(value).cast("string"), "$.schema")
    rows = messages.select(schema.alias("s")).filter("s is not null").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"messages carry more than {most} schemas")
    return sorted(r["s"] for r in rows)


def decode_described(messages: DataFrame, value: str = "value", most: int = 100) -> list[tuple[T.DataType, DataFrame]]:
    """(type, messages of that schema with ``payload`` decoded to it) for each schema that the messages
    carry. A message without a schema is in none of them (see ``undescribed``); a payload that is null is null."""
    return [(dtype, messages.filter(F.get_json_object(F.col(value).cast("string"), "$.schema") == s)
             .withColumn("payload", payload(F.col(value).cast("string"), dtype)))
            for s in message_schemas(messages, value, most) for dtype in [schema_type(json.loads(s))]]


def undescribed(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages that carry no schema."""
    return messages.filter(F.get_json_object(F.col(value).cast("string"), "$.schema").isNull())


def by_schema(route: Callable[[T.DataType, DataFrame], DataFrame], messages: DataFrame, value: str = "value") -> DataFrame | None:
    """One table from all routes: ``route(type, decoded)`` gives each the same columns."""
    out = None
    for dtype, decoded in decode_described(messages, value):
        part = route(dtype, decoded)
        out = part if out is None else out.unionByName(part)
    return out
