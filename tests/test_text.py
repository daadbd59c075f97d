"""Main-artist parsing and report formatting (FIXTURES §3)."""

import time

import pytest
from pyspark.sql import functions as F

from tastebud.functions.text import decimal_text, fixed_width_line, main_artist, py_strip

CASES = [
    ("['A', 'B']", "A"),
    ("[\"Guns N' Roses\"]", "Guns N' Roses"),
    ("[' A ']", "A"),
    ("['', 'B']", ""),
    ("'solo'", "solo"),
    ("[]", None),
    ("plain", None),
    ("{'a':1}", None),
    (None, None),
    ("['x\\xa0y']", "x y"),
    ("['He said \"x\"']", 'He said "x"'),
    ("['a\\'b\"c']", "a'b\"c"),
    ("['tab\there']", "tab\there"),
    ("[\"  spaced  \", 'z']", "spaced"),
    ("['A'] junk", None),
    ("['A']]", None),
    ("['A',]", "A"),
    ("['A',,]", None),
    ("['A' 'B']", "AB"),
    ("['\\101']", "A"),
    ("['a\\\\x41']", "a\\x41"),
    ("['a\\\\\\x41']", "a\\A"),
    ("[['A']]", None),
    ("['caf\\u00e9']", "caf\u00e9"),
    ("[1, 'A']", None),
    ("['\\U0001F600 band']", "\U0001F600 band"),
    ("['a\\U0010ffffb']", "a\U0010ffffb"),
    ("['\\\\U0001F600']", "\\U0001F600"),
    ("['a\\ufeffb']", "a\ufeffb"),
    ("['a\\ud83db']", "a\ufffdb"),
    ("['\\U00110000']", None),
    ("['\\U0001F60']", None),
    ("['\\x4']", None),
    ("['A', '\\u12']", None),
    ("['\\\\x4']", "\\x4"),
]


def test_main_artist(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CASES)], "i int, s string")
    got = {r.i: r.a for r in df.select("i", main_artist("s").alias("a")).collect()}
    for i, (_, want) in enumerate(CASES):
        assert got[i] == want, (CASES[i], got[i])


def test_py_strip_unicode_space(spark):
    df = spark.createDataFrame([("  x 　",)], "s string")
    assert df.select(py_strip("s").alias("s")).first().s == "x"


@pytest.mark.parametrize("score,text", [(0.12345, "0.1235"), (0.123449, "0.1234"), (-0.00005, "-0.0001"),
                                        (-0.00004, "0.0000"), (1.0, "1.0000"), (0.0, "0.0000")])
def test_decimal_text(spark, score, text):
    df = spark.createDataFrame([(score,)], "s double")
    assert df.select(decimal_text("s").alias("t")).first().t == text


def test_fixed_width_line(spark):
    df = spark.createDataFrame([(3, "abc", 0.5), (100, "x" * 60, 0.25)], "r int, n string, s double")
    lines = [r.l for r in df.select(fixed_width_line("r", "n", "s").alias("l")).collect()]
    assert lines[0] == " 3. " + "abc".ljust(50) + " 0.5000"
    assert lines[1] == "100. " + "x" * 60 + " 0.2500"


def test_literals_without_escapes_are_not_decoded(spark):
    def seconds(inside):
        rows = spark.range(0, 40_000, 1, 1).select(F.concat(F.lit("['"), F.col("id").cast("string"), F.lit(inside)).alias("s"))
        took = []
        for _ in range(3):
            t0 = time.time()
            n = rows.select(main_artist("s").alias("a")).where("length(a) > 7").count()
            took.append(time.time() - t0)
        assert n == 40_000
        return min(took)

    assert seconds(" and the band', 'B']") < 0.75 * seconds(" and the b\\x61nd', 'B']")
