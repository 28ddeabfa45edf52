"""Column helpers and driver-side checks."""

from pyspark.sql import functions as F

from panelmerge.functions import decade, grade_dq, grade_value, strip_ws, to_number, truncate_label
from panelmerge.operators.stats import type_check


def test_truncate_label(spark):
    df = spark.createDataFrame([("x" * 28,), ("y" * 29,), (None,)], "s string")
    got = [r.t for r in df.select(truncate_label("s").alias("t")).collect()]
    assert got == ["x" * 28, "y" * 25 + "...", None]


def test_strip_unicode_whitespace(spark):
    raw = [" Viet Nam\t", " Chad　", " Peru\n", "plain"]
    df = spark.createDataFrame([(s,) for s in raw], "s string")
    assert [r.t for r in df.select(strip_ws("s").alias("t")).collect()] == [s.strip() for s in raw]


def test_to_number_and_decade(spark):
    df = spark.createDataFrame([("1.5",), (" 2 ",), ("abc",), ("nan",), (None,)], "s string")
    assert [r.v for r in df.select(to_number("s").alias("v")).collect()] == [1.5, 2.0, None, None, None]
    y = spark.createDataFrame([(1950,), (1959,), (2024,)], "y int")
    assert [r.d for r in y.select(decade("y").alias("d")).collect()] == [1950, 1950, 2020]


def test_to_number_takes_decimal_numbers_only(spark):
    raw = ["10d", "1f", "0x10", "  ", "", "NaN", "Infinity", "1,5", " -.5 ", "+2.", "1e3", "\t7 "]
    df = spark.createDataFrame([(x,) for x in raw], "s string")
    got = [r.v for r in df.select(to_number("s").alias("v")).collect()]
    assert got == [None] * 8 + [-0.5, 2.0, 1000.0, 7.0]


def test_grades(spark):
    df = spark.createDataFrame([(100.0,), (80.0,), (60.0,), (59.9,), (90.0,), (75.0,)], "s double")
    got = [(r.a, r.b) for r in df.select(grade_dq("s").alias("a"), grade_value("s").alias("b")).collect()]
    assert got == [("A", "A"), ("B", "B"), ("C", "C"), ("D", "D"), ("B", "A"), ("C", "B")]


def test_type_check_reports_without_failing(spark):
    df = spark.createDataFrame([(1.0, "x", 2)], "a double, b string, c int")
    assert type_check(df, ["a", "b", "c", "absent"]) == [("a", "double", True), ("b", "string", False),
                                                         ("c", "int", True)]
