"""Decode -> parse -> flatten: topic values to the 15-column object table.

One function chain serves batch and streaming DataFrames alike. The chain is
map-only (no shuffle): a Project for the JSON parse, then the flatten Project,
which stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from neoflow.functions.casts import first_element, tolerant_double, tolerant_int
from neoflow.schemas import MESSAGE_SCHEMA, NARROW_MESSAGE_SCHEMA, OUTPUT_FIELDS

PARSED = "parsed_message"
_APPROACH_PREFIX = "close_approach_data."


def decode_value(df: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Topic value bytes -> text. The text column keeps the name ``value_col``."""
    cols = [F.col(c) for c in (keep or [])]
    return df.select(*cols, F.col(value_col).cast("string").alias(value_col))


def message_schema(kind: str | T.StructType = "narrow") -> T.StructType:
    """``"full"``: the whole 27-leaf message schema; ``"narrow"``: only the 15
    leaves the flatten reads (cheaper to parse, same values with partial JSON
    results on, the Spark 4 default); or a StructType given by the caller."""
    if isinstance(kind, T.StructType):
        return kind
    if kind == "full":
        return MESSAGE_SCHEMA
    if kind == "narrow":
        return NARROW_MESSAGE_SCHEMA
    raise ValueError(f"unknown schema kind {kind!r}")


def parse_messages(df: DataFrame, value_col: str = "value", schema="narrow",
                   out: str = PARSED) -> DataFrame:
    """Add ``out`` = ``from_json(value, schema)`` (PERMISSIVE, no options).

    Unparseable text yields a struct of NULL fields, a NULL / empty value a
    NULL struct; neither row is dropped."""
    return df.withColumn(out, F.from_json(F.col(value_col), message_schema(schema)))


def _path(base: Column, path: str) -> Column:
    for part in path.split("."):
        base = base.getField(part)
    return base


def flatten_columns(parsed: str | Column = PARSED) -> list[Column]:
    """The 15 output columns read from the parsed struct: nested paths, the
    first close approach only, tolerant int / double casts, renames."""
    root = F.col(parsed) if isinstance(parsed, str) else parsed
    first = first_element(root.getField("close_approach_data"))
    cols = []
    for name, path, kind in OUTPUT_FIELDS:
        if path.startswith(_APPROACH_PREFIX):
            c = _path(first, path[len(_APPROACH_PREFIX):])
        else:
            c = _path(root, path)
        if kind == "int":
            c = tolerant_int(c)
        elif kind == "double":
            c = tolerant_double(c)
        cols.append(c.alias(name))
    return cols


def flatten(df: DataFrame, parsed: str = PARSED, keep: list[str] | None = None) -> DataFrame:
    """Parsed struct -> the 15 output columns (plus ``keep`` columns first)."""
    return df.select(*[F.col(c) for c in (keep or [])], *flatten_columns(parsed))


def parse_and_flatten(df: DataFrame, value_col: str = "value", schema="narrow",
                      keep: list[str] | None = None) -> DataFrame:
    """Record table (value as bytes or text) -> 15-column object table."""
    keep = keep or []
    text = df.select(*[F.col(c) for c in keep], F.col(value_col).cast("string").alias(value_col))
    return flatten(parse_messages(text, value_col, schema), keep=keep)
