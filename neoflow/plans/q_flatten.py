"""Parse + flatten queries (PRJ-*): the payload goes through JSON text and
back; each oracle reads the same values straight from the columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neoflow.functions.casts import field_of_elements, tolerant_double, tolerant_int
from neoflow.operators.parse import (PARSED, decode_value, flatten, parse_and_flatten,
                                     parse_messages)
from neoflow.operators.predicates import date_range
from neoflow.plans.topics_fixture import payload_topic_records
from neoflow.plans.registry import register, register_subset
from neoflow.plans.tables import table
from neoflow.schemas import OUTPUT_COLUMNS
from neoflow.session import scratch_path

# ---------------------------------------------------------------- oracles

FLATTEN_SELECT = """
  strftime(o.o_orderdate, '%Y-%m-%d') AS date,
  CAST(o.o_orderkey AS INTEGER) AS object_id,
  CAST(o.o_custkey AS INTEGER) AS object_neo_reference_id,
  '(' || CAST(o.o_orderkey AS VARCHAR) || ') ' || o.o_orderpriority AS object_name,
  o.o_totalprice AS absolute_magnitude_h,
  o.o_totalprice AS estimated_diameter_min_km,
  CAST(o.o_custkey AS DOUBLE) AS estimated_diameter_max_km,
  o.o_orderstatus = 'F' AS is_potentially_hazardous_asteroid,
  strftime(l.l_shipdate, '%Y-%m-%d %H:%M') AS close_approach_date_full,
  l.l_quantity AS relative_velocity_km_per_sec,
  l.l_extendedprice AS relative_velocity_km_per_hour,
  l.l_discount AS miss_distance_astronomical,
  l.l_tax AS miss_distance_lunar,
  CAST(l.l_partkey AS DOUBLE) AS miss_distance_kilometers,
  o.o_orderpriority = '1-URGENT' AS is_sentry_object"""

FLATTEN_SQL = f"SELECT {FLATTEN_SELECT}\nFROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey"

DATE_LO, DATE_HI = "1995-01-01", "1996-12-31"


def payload_table(spark: SparkSession, sf_dir: str, schema="narrow") -> DataFrame:
    """Consumer side in batch: the payload topic (written once per session
    from the fixture) -> decode -> parse -> flatten."""
    return parse_and_flatten(payload_topic_records(spark, sf_dir), schema=schema)


# ---------------------------------------------------------------- composed

@register("flatten_objects", FLATTEN_SQL, ["PRJ-1", "PRJ-2", "PRJ-3", "PRJ-5", "PRJ-6",
                                           "PRJ-7", "PRJ-8", "PRJ-9", "PRJ-10", "PRJ-11"])
def flatten_objects(spark, sf_dir):
    """The 15-column object table with each object's first approach."""
    return payload_table(spark, sf_dir)


@register("flatten_objects_full_schema", FLATTEN_SQL, ["PRJ-2"])
def flatten_objects_full_schema(spark, sf_dir):
    """Same, parsing the whole 27-leaf message schema (reference behaviour)."""
    return payload_table(spark, sf_dir, schema="full")


@register("flatten_date_range",
          FLATTEN_SQL + f"\nWHERE strftime(o.o_orderdate, '%Y-%m-%d') BETWEEN '{DATE_LO}' AND '{DATE_HI}'",
          ["PRJ-12"])
def flatten_date_range(spark, sf_dir):
    return date_range(payload_table(spark, sf_dir), "date", DATE_LO, DATE_HI)


@register("first_element_empty",
          FLATTEN_SQL.replace("LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey",
                              "LEFT JOIN (SELECT * FROM lineitem WHERE false) l ON true")
          + "\nWHERE NOT EXISTS (SELECT 1 FROM lineitem x WHERE x.l_orderkey = o.o_orderkey)",
          ["PRJ-9"])
def first_element_empty(spark, sf_dir):
    """Messages whose approach array is empty: approach columns are NULL and
    the object columns are kept."""
    recs = payload_topic_records(spark, sf_dir)
    parsed = parse_messages(decode_value(recs), schema="narrow")
    empty = parsed.filter(F.size(F.col(f"{PARSED}.close_approach_data")) == 0)
    return flatten(empty)


@register("prj_04_qualified_names", """
SELECT CAST(o.o_orderkey AS INTEGER) AS object_id, o.o_custkey AS customer, c.n_messages
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
JOIN (SELECT o_custkey, count(*) AS n_messages FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
      GROUP BY o_custkey) c ON c.o_custkey = o.o_custkey""", ["PRJ-4"])
def prj_04_qualified_names(spark, sf_dir):
    """Two aliased relations over the same messages, joined and projected by
    qualified names: every message with the number of its customer's messages."""
    parsed = parse_messages(decode_value(payload_topic_records(spark, sf_dir)), schema="narrow")
    # Parsed once: both relations read the two numbers of each message, not the messages.
    path = scratch_path(spark, "message-ids")
    parsed.select(tolerant_int(F.col(f"{PARSED}.id")).alias("id"),
                  F.col(f"{PARSED}.neo_reference_id").cast("long").alias("ref")).write.parquet(path)
    ids = spark.read.parquet(path)
    message = ids.alias("message")
    customer = ids.groupBy("ref").agg(F.count(F.lit(1)).alias("n")).alias("customer")
    return message.join(customer, F.col("message.ref") == F.col("customer.ref")).select(
        F.col("message.id").alias("object_id"), F.col("customer.ref").alias("customer"),
        F.col("customer.n").alias("n_messages"))


@register("prj_08_array_field",
          """SELECT CAST(o.o_orderkey AS INTEGER) AS object_id,
                    CASE WHEN l.l_orderkey IS NULL THEN 0 ELSE 2 END AS n_approaches,
                    l.l_quantity AS first_km_per_sec,
                    l.l_tax AS second_km_per_sec
             FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey""",
          ["PRJ-8"])
def prj_08_array_field(spark, sf_dir):
    """A field of every array element (array of struct -> array of field),
    then its first and second entries."""
    parsed = parse_messages(decode_value(payload_topic_records(spark, sf_dir)), schema="full")
    kps = field_of_elements(F.col(f"{PARSED}.close_approach_data"), "relative_velocity.kilometers_per_second")
    return parsed.select(
        tolerant_int(F.col(f"{PARSED}.id")).alias("object_id"),
        F.size(kps).alias("n_approaches"),
        tolerant_double(F.get(kps, F.lit(0))).alias("first_km_per_sec"),
        tolerant_double(F.get(kps, F.lit(1))).alias("second_km_per_sec"))


# Tolerant casts on text built from `part`: one column per edge shape.
_CAST_TEXTS = {
    "name": ("p_name", "p_name"),
    "dec": ("concat(p_size, '.', p_size)", "CAST(p_size AS VARCHAR) || '.' || CAST(p_size AS VARCHAR)"),
    "neg": ("concat('-', p_size, '.9')", "'-' || CAST(p_size AS VARCHAR) || '.9'"),
    "pad": ("concat(' ', p_partkey, ' ')", "' ' || CAST(p_partkey AS VARCHAR) || ' '"),
    "lead_dot": ("concat('.', p_size)", "'.' || CAST(p_size AS VARCHAR)"),
    "trail_dot": ("concat(p_size, '.')", "CAST(p_size AS VARCHAR) || '.'"),
    "plus": ("concat('+', p_partkey)", "'+' || CAST(p_partkey AS VARCHAR)"),
    "exp": ("concat(p_size, 'e3')", "CAST(p_size AS VARCHAR) || 'e3'"),
    "big": ("concat(p_partkey, '0000000000')", "CAST(p_partkey AS VARCHAR) || '0000000000'"),
}


def _duck_int(x: str) -> str:
    # Independent formulation: truncate the double value; exponent / hex
    # text is not an int.
    return (f"CASE WHEN regexp_matches({x}, '[eExX]') THEN NULL "
            f"ELSE TRY_CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS INTEGER) END")


_CASTS_SQL = "SELECT p_partkey, " + ", ".join(
    [f"{_duck_int(d)} AS i_{k}" for k, (_, d) in _CAST_TEXTS.items()]
    + [f"TRY_CAST({d} AS DOUBLE) AS d_{k}" for k, (_, d) in _CAST_TEXTS.items()]) + " FROM part"


@register("tolerant_casts", _CASTS_SQL, ["PRJ-10", "PRJ-11"])
def tolerant_casts(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    texts = {k: F.expr(s) for k, (s, _) in _CAST_TEXTS.items()}
    return p.select("p_partkey",
                    *[tolerant_int(c).alias(f"i_{k}") for k, c in texts.items()],
                    *[tolerant_double(c).alias(f"d_{k}") for k, c in texts.items()])


@register("bad_messages_kept",
          """SELECT (SELECT count(*) FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey)
                    + (SELECT count(*) FROM documents) AS n_rows,
                    (SELECT count(*) FROM documents) AS n_null_date,
                    (SELECT count(*) FROM documents) AS n_all_null""",
          ["PRJ-2"])
def bad_messages_kept(spark, sf_dir):
    """Payload messages plus free text (documents.text) as messages: the
    text rows are kept as rows of 15 NULLs, not dropped."""
    good = payload_topic_records(spark, sf_dir).select(F.col("value").cast("string").alias("value"))
    bad = table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    out = parse_and_flatten(good.unionByName(bad))
    all_null = F.lit(True)
    for c in OUTPUT_COLUMNS:
        all_null = all_null & F.col(c).isNull()
    return out.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.count(F.when(F.col("date").isNull(), 1)).alias("n_null_date"),
                   F.count(F.when(all_null, 1)).alias("n_all_null"))


# ---------------------------------------------------------------- per id

_OBJ = ["date", "object_id", "object_name"]
_APPROACH = ["object_id", "close_approach_date_full", "relative_velocity_km_per_sec",
             "relative_velocity_km_per_hour", "miss_distance_astronomical",
             "miss_distance_lunar", "miss_distance_kilometers"]

register_subset("prj_01_decode_value", "flatten_objects", _OBJ, ["PRJ-1"])
register_subset("prj_02_parse_json", "flatten_objects_full_schema", OUTPUT_COLUMNS, ["PRJ-2"])
register_subset("prj_03_add_column", "flatten_objects", ["object_id", "absolute_magnitude_h"], ["PRJ-3"])
register_subset("prj_05_project_list", "flatten_objects", OUTPUT_COLUMNS, ["PRJ-5"])
register_subset("prj_06_rename", "flatten_objects",
                ["object_id", "object_neo_reference_id", "object_name"], ["PRJ-6"])
register_subset("prj_07_nested_path", "flatten_objects",
                ["object_id", "estimated_diameter_min_km", "estimated_diameter_max_km"], ["PRJ-7"])
register_subset("prj_09_first_element", "flatten_objects", _APPROACH, ["PRJ-9"])
register_subset("prj_10_tolerant_int", "tolerant_casts",
                ["p_partkey"] + [f"i_{k}" for k in _CAST_TEXTS], ["PRJ-10"])
register_subset("prj_11_tolerant_double", "tolerant_casts",
                ["p_partkey"] + [f"d_{k}" for k in _CAST_TEXTS], ["PRJ-11"])
register_subset("prj_12_date_range", "flatten_date_range", _OBJ, ["PRJ-12"])

