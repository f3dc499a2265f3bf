"""JSON text helpers: stamp a field into raw object text, serialise keeping
nulls, and the UTF-8 byte codec of topic values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stamp_field_raw(obj_text, name: str, value) -> Column:
    """Set ``"name": value`` (a JSON string, added last) in the raw text of a JSON
    object. Other fields keep their text; an object that already has the field is
    rewritten without it (its members as variants: numbers and nesting stay,
    white space doesn't). Text that isn't an object, and NULL, pass unchanged."""
    t = F.trim(_col(obj_text))
    v = F.to_json(F.struct(_col(value).cast("string").alias(name)))  # {"name":"..."}
    member = F.substring(v, F.lit(2), F.length(v) - 2)  # "name":"..."  (escaped)
    is_obj = t.startswith("{") & t.endswith("}")
    members = F.from_json(t, "map<string,variant>")
    old = F.to_json(F.map_filter(members, lambda k, _: k != name))
    # The name may occur deeper or in a text only; whether it is a member is known after parsing.
    has = F.contains(t, F.lit(f'"{name}"')) & F.coalesce(F.map_contains_key(members, F.lit(name)), F.lit(False))
    base = F.when(has, old).otherwise(t)
    is_empty = base.rlike(r"^\{\s*\}$")  # anchored: stops at the 2nd char of a non-empty object
    head = F.substring(base, F.lit(1), F.length(base) - 1)  # without the closing brace
    return (F.when(~is_obj, _col(obj_text))
            .when(is_empty, F.concat(F.lit("{"), member, F.lit("}")))
            .otherwise(F.concat(head, F.lit(","), member, F.lit("}"))))


def to_json_keep_nulls(c) -> Column:
    """Struct -> JSON text, writing null fields as ``null`` like a plain
    dict dump does (Spark's default drops them)."""
    return F.to_json(_col(c), {"ignoreNullFields": "false"})


def encode_utf8(c) -> Column:
    return F.encode(_col(c), "UTF-8")

