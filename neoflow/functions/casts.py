"""Tolerant casts and first-element access that behave the same whether ANSI
mode is on (Spark 4 default) or off.

Plain ``cast('int')`` under ANSI throws on bad text, and ``try_cast('int')``
returns NULL for decimals such as ``'12.7'`` where the non-ANSI cast truncates
to 12. ``tolerant_int`` reproduces the non-ANSI string -> int rules with
built-in expressions:

* leading / trailing ASCII whitespace and control characters are ignored;
* an optional sign, then digits, then optionally ``.`` and digits: the
  fractional part is dropped (truncation toward zero);
* the integral part may be empty (``'.5'`` -> 0, ``'.'`` -> 0), but the text
  may not be empty or a bare sign;
* anything else (exponent, hex, suffix letters) or an out-of-range value -> NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters the non-ANSI cast skips around a number (ASCII
# control characters, space and DEL) and the accepted number shape.
_BLANK = r"[\x00-\x20\x7f]*"
_INT_TEXT = rf"^{_BLANK}([+-]?)([0-9]*)(?:\.[0-9]*)?{_BLANK}$"
_BARE_SIGN = rf"^{_BLANK}[+-]?{_BLANK}$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerant_int(c) -> Column:
    """String (or number) -> int with the non-ANSI truncating rules; NULL on
    bad input instead of an error."""
    s = _col(c).cast("string")
    # Fast path: plain integer text casts directly (the ANSI cast trims and
    # takes a sign just like the legacy one); the regex path runs only for
    # the rest (decimals, '.5', junk), thanks to coalesce short-circuiting.
    fast = s.try_cast("int")
    sign = F.regexp_extract(s, _INT_TEXT, 1)
    digits = F.regexp_extract(s, _INT_TEXT, 2)
    ok = s.rlike(_INT_TEXT) & ~s.rlike(_BARE_SIGN)
    # An empty integral part ('.5', '-.') is zero.
    num = F.when(digits == "", F.lit("0")).otherwise(F.concat(sign, digits))
    return F.coalesce(fast, F.when(ok, num.try_cast("int")))


def tolerant_double(c) -> Column:
    """String -> double; NULL on bad input (equals the non-ANSI cast)."""
    return _col(c).try_cast("double")


def first_element(arr) -> Column:
    """Element 0 of an array; NULL when the array is NULL or empty (plain
    ``arr[0]`` throws for an empty array under ANSI)."""
    return F.get(_col(arr), F.lit(0))


def field_of_elements(arr, path: str) -> Column:
    """Array of struct -> array of the (dotted) field of every element."""
    parts = path.split(".")

    def pick(x):
        for p in parts:
            x = x.getField(p)
        return x

    return F.transform(_col(arr), pick)
