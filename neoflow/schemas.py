"""Schemas: the message (one object per topic value), the 15-column output
table, the record table that stands for a topic, and the feed document.

The message schema is the fixed, hand-written nested schema of the consumer:
11 top-level fields, 27 leaves, everything nullable.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _B, _L = T.StringType(), T.DoubleType(), T.BooleanType(), T.LongType()


def _f(name, dtype):
    return T.StructField(name, dtype, True)


def _diameter():
    return T.StructType([_f("estimated_diameter_min", _D),
                         _f("estimated_diameter_max", _D)])


# The message field names and nesting, and the output column
# names with their source paths, as the consumer defines them (they must
# equal the producer's JSON and the landed table's columns).

APPROACH_SCHEMA = T.StructType([
    _f("close_approach_date", _S),
    _f("close_approach_date_full", _S),
    _f("epoch_date_close_approach", _L),
    _f("relative_velocity", T.StructType([
        _f("kilometers_per_second", _S),
        _f("kilometers_per_hour", _S),
        _f("miles_per_hour", _S),
    ])),
    _f("miss_distance", T.StructType([
        _f("astronomical", _S),
        _f("lunar", _S),
        _f("kilometers", _S),
        _f("miles", _S),
    ])),
])

MESSAGE_SCHEMA = T.StructType([
    _f("links", T.StructType([_f("self", _S)])),
    _f("id", _S),
    _f("neo_reference_id", _S),
    _f("name", _S),
    _f("nasa_jpl_url", _S),
    _f("absolute_magnitude_h", _D),
    _f("estimated_diameter", T.StructType([
        _f("kilometers", _diameter()),
        _f("meters", _diameter()),
        _f("miles", _diameter()),
        _f("feet", _diameter()),
    ])),
    _f("is_potentially_hazardous_asteroid", _B),
    _f("close_approach_data", T.ArrayType(APPROACH_SCHEMA, True)),
    _f("is_sentry_object", _B),
    _f("current_date", _S),
])

# (output column, message path, kind) in output order. kind: "raw" keeps the
# parsed type, "int" / "double" go through the tolerant casts, and a path
# starting with "close_approach_data." is read from the FIRST approach only.
OUTPUT_FIELDS = [
    ("date", "current_date", "raw"),
    ("object_id", "id", "int"),
    ("object_neo_reference_id", "neo_reference_id", "int"),
    ("object_name", "name", "raw"),
    ("absolute_magnitude_h", "absolute_magnitude_h", "raw"),
    ("estimated_diameter_min_km", "estimated_diameter.kilometers.estimated_diameter_min", "raw"),
    ("estimated_diameter_max_km", "estimated_diameter.kilometers.estimated_diameter_max", "raw"),
    ("is_potentially_hazardous_asteroid", "is_potentially_hazardous_asteroid", "raw"),
    ("close_approach_date_full", "close_approach_data.close_approach_date_full", "raw"),
    ("relative_velocity_km_per_sec", "close_approach_data.relative_velocity.kilometers_per_second", "double"),
    ("relative_velocity_km_per_hour", "close_approach_data.relative_velocity.kilometers_per_hour", "double"),
    ("miss_distance_astronomical", "close_approach_data.miss_distance.astronomical", "double"),
    ("miss_distance_lunar", "close_approach_data.miss_distance.lunar", "double"),
    ("miss_distance_kilometers", "close_approach_data.miss_distance.kilometers", "double"),
    ("is_sentry_object", "is_sentry_object", "raw"),
]

OUTPUT_COLUMNS = [name for name, _, _ in OUTPUT_FIELDS]


def _leaf(schema: T.DataType, path: str) -> T.DataType:
    """Type of the leaf at a dotted path; arrays are walked through."""
    for name in path.split("."):
        while isinstance(schema, T.ArrayType):
            schema = schema.elementType
        schema = schema[name].dataType
    return schema


# "raw" columns have their leaf's type, cast ones what they are cast to.
OUTPUT_SCHEMA = T.StructType([
    _f(name, {"int": T.IntegerType(), "double": _D}.get(kind) or _leaf(MESSAGE_SCHEMA, path))
    for name, path, kind in OUTPUT_FIELDS])

# Column set of Spark's Kafka source; a directory of Parquet files with this
# schema stands for a topic when no broker is reachable.
RECORD_SCHEMA = T.StructType([
    _f("key", T.BinaryType()),
    _f("value", T.BinaryType()),
    _f("topic", _S),
    _f("partition", T.IntegerType()),
    _f("offset", _L),
    _f("timestamp", T.TimestampType()),
    _f("timestampType", T.IntegerType()),
])
RECORD_COLUMNS = [f.name for f in RECORD_SCHEMA.fields]

# Feed document: only the member we need; objects stay raw JSON text so that
# unknown fields and explicit nulls pass through the fan-out untouched.
FEED_SCHEMA = T.StructType([
    _f("near_earth_objects", T.MapType(_S, T.ArrayType(_S, True), True)),
])
FEED_MEMBER = "near_earth_objects"


def narrowed(schema: T.StructType, paths: list[str]) -> T.StructType:
    """Keep only the leaves named by dotted ``paths`` (arrays are walked
    through transparently). Parsing fewer leaves is cheaper; with partial
    JSON results on (the Spark 4 default) it gives the same values for the
    leaves kept."""
    tree: dict = {}
    for p in paths:
        node = tree
        for part in p.split("."):
            node = node.setdefault(part, {})

    def keep(dtype, node):
        if not node:
            return dtype
        if isinstance(dtype, T.ArrayType):
            return T.ArrayType(keep(dtype.elementType, node), dtype.containsNull)
        if isinstance(dtype, T.StructType):
            return T.StructType([T.StructField(f.name, keep(f.dataType, node[f.name]), f.nullable)
                                 for f in dtype.fields if f.name in node])
        raise ValueError(f"path goes below a leaf of type {dtype.simpleString()}")

    return keep(schema, tree)


NARROW_MESSAGE_SCHEMA = narrowed(MESSAGE_SCHEMA, [p for _, p, _ in OUTPUT_FIELDS])
