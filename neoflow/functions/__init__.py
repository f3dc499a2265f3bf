"""Column functions (built-in Spark expressions only, no UDFs)."""

from neoflow.functions.casts import first_element, tolerant_double, tolerant_int
from neoflow.functions.dates import day_calendar, exact_day, format_day, parse_day
from neoflow.functions.json import encode_utf8, stamp_field_raw, to_json_keep_nulls

__all__ = ["first_element", "tolerant_double", "tolerant_int", "day_calendar",
           "exact_day", "format_day", "parse_day", "encode_utf8",
           "stamp_field_raw", "to_json_keep_nulls"]
