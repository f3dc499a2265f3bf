import math

import pytest
from pyspark.sql import functions as F

from neoflow.functions.casts import first_element, tolerant_double, tolerant_int

# Text -> int under the non-ANSI cast (FIXTURES.md §6) plus
# a few more shapes.
INT_CASES = [
    (" 12 ", 12), ("12.7", 12), ("-12.9", -12), (".5", 0), ("5.", 5), ("+7", 7),
    ("1e3", None), ("12.x", None), ("", None), ("-", None), ("2147483648", None),
    ("0x1F", None), ("12L", None), ("-2147483648", -2147483648), ("2147483647", 2147483647),
    (".", 0), ("+", None), ("\t42\n", 42), ("0000000000012", 12), ("1 2", None), (None, None),
]


def test_tolerant_int_matches_legacy_cast(spark):
    df = spark.createDataFrame([(t,) for t, _ in INT_CASES], "t string")
    got = [r[0] for r in df.select(tolerant_int("t")).collect()]
    assert got == [v for _, v in INT_CASES]


def test_tolerant_int_equals_non_ansi_cast(spark):
    texts = [t for t, _ in INT_CASES]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = [r[0] for r in df.select(F.col("t").cast("int")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    mine = [r[0] for r in df.select(tolerant_int("t")).collect()]
    assert mine == legacy


def test_tolerant_double(spark):
    cases = ["1.5", " 2 ", "NaN", "Infinity", "-1e3", "x", "", None, "1.5d"]
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = [r[0] for r in df.select(F.col("t").cast("double")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    mine = [r[0] for r in df.select(tolerant_double("t")).collect()]
    for a, b in zip(mine, legacy):
        assert (a is None and b is None) or (math.isnan(a) and math.isnan(b)) or a == b


def test_first_element_no_error_under_ansi(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (None,)], "a array<int>")
    assert [r[0] for r in df.select(first_element("a")).collect()] == [1, None, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_casts_same_under_both_modes(spark, ansi):
    df = spark.createDataFrame([(t,) for t, _ in INT_CASES], "t string")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = [r[0] for r in df.select(tolerant_int("t")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert got == [v for _, v in INT_CASES]


def test_tolerant_int_random_texts_equal_non_ansi_cast(spark):
    """5,000 random texts over digits, signs, dots, blanks, controls and a
    few letters, checked in one job against the non-ANSI cast."""
    import random
    rng = random.Random(7)
    alphabet = "0123456789" * 3 + "+-..  \t\n\x00\x7fe xL" + "9" * 5
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    texts += ["2147483647", "2147483648", "-2147483648", "-2147483649", "+0", "-0", "00.00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = {r.i: r.v for r in df.select("i", F.col("t").cast("int").alias("v")).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    mine = {r.i: r.v for r in df.select("i", tolerant_int("t").alias("v")).collect()}
    bad = [(texts[i], mine[i], legacy[i]) for i in legacy if mine[i] != legacy[i]]
    assert not bad, bad[:10]


def test_tolerant_double_random_texts_equal_non_ansi_cast(spark):
    import random
    rng = random.Random(11)
    alphabet = "0123456789" * 3 + "+-..eE  dDfF" + "x"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 10))) for _ in range(3000)]
    texts += ["NaN", "-Infinity", "Infinity", "inf", "1e308", "1e309", "-0.0", "0x1p3"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = {r.i: r.v for r in df.select("i", F.col("t").cast("double").alias("v")).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    mine = {r.i: r.v for r in df.select("i", tolerant_double("t").alias("v")).collect()}

    def same(a, b):
        return (a is None and b is None) or (a is not None and b is not None and
                                             (a == b or (math.isnan(a) and math.isnan(b))))
    bad = [(texts[i], mine[i], legacy[i]) for i in legacy if not same(mine[i], legacy[i])]
    assert not bad, bad[:10]
