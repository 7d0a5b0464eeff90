"""Literal edge cases for the column helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from regstat import catalogue as cat
from regstat.functions.codes import group_flag, main_diagnosis
from regstat.functions.scalar import (
    four_digit,
    null_sentinels,
    pad_code,
    sex_label,
    try_int,
    valid_person_id,
)


def _group(name):
    return next(g for s in cat.SERVICES for g in s.groups if g.name == name)


def _flags(spark, codes, group):
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    return [r[0] for r in df.select(group_flag("code", _group(group))).collect()]


def test_prefix_range_edges(spark):
    assert _flags(spark, ["F00", "F99", "F9X", "F1", "f32", "G00"], "F00_F99") == [1, 1, 0, 1, 0, 0]


def test_two_letter_range(spark):
    assert _flags(spark, ["S00", "SZZ", "T78", "T79"], "S00_T78") == [1, 1, 1, 0]


def test_four_char_range(spark):
    codes = ["S720", "S722", "S723", "S729", "S72", "S72.0"]
    assert _flags(spark, codes, "S720_S729") == [1, 1, 1, 1, 0, 0]
    assert _flags(spark, codes, "S720_S722") == [1, 1, 0, 0, 0, 0]


def test_f17_excluded(spark):
    codes = ["F10", "F16", "F17", "F18"]
    assert _flags(spark, codes, "F10_F16_F18_F19") == [1, 1, 0, 1]
    assert _flags(spark, codes, "F11_F16_F18_F19") == [0, 1, 0, 1]
    assert _flags(spark, codes, "F10") == [1, 0, 0, 0]


def test_null_code_flag_is_zero(spark):
    df = spark.createDataFrame([(None,)], "code string")
    assert df.select(group_flag("code", _group("I00_I99"))).first()[0] == 0


def test_main_diagnosis_selectors(spark):
    df = spark.createDataFrame(
        [(6, 11, 1, 1), (6, 13, 1, 1), (5, 12, 1, 1), (6, 12, 2, 1), (None, 11, 1, 2)],
        "code_type int, code_no int, axis int, condition int",
    )
    by_type = df.filter(main_diagnosis(cat.MAIN_BY_TYPE)).count()
    by_axis = df.filter(main_diagnosis(cat.MAIN_BY_AXIS)).count()
    assert (by_type, by_axis) == (2, 3)


def test_person_id_length_ignores_trailing_blanks(spark):
    ids = ["12345678901", "123456789012", "12345678901  ", None]
    df = spark.createDataFrame([(i,) for i in ids], "pid string")
    assert [r[0] for r in df.select(valid_person_id("pid")).collect()] == [True, False, True, False]


def test_sex_recode(spark):
    rows = [("1", "2"), (None, "2"), (None, "9"), (None, None)]
    df = spark.createDataFrame(rows, "d string, s string")
    got = [r[0] for r in df.select(sex_label("d", "s")).collect()]
    assert got == [cat.SEX_MEN, cat.SEX_WOMEN, cat.SEX_UNKNOWN, cat.SEX_UNKNOWN]


def test_pad_never_truncates(spark):
    df = spark.createDataFrame([("301",), ("12345",), ("0301",), ("1",)], "m string")
    got = [tuple(r) for r in df.select(pad_code("m"), four_digit(pad_code("m"))).collect()]
    assert got == [("0301", True), ("12345", False), ("0301", True), ("0001", True)]


def test_sentinels(spark):
    df = spark.createDataFrame([("9999",), ("",), ("0301",), (None,)], "m string")
    assert [r[0] for r in df.select(null_sentinels("m")).collect()] == [None, None, "0301", None]


def test_bad_integer_text_is_null(spark):
    df = spark.createDataFrame([("x",), ("2014",), (None,)], "y string")
    assert [r[0] for r in df.select(try_int("y")).collect()] == [None, 2014, None]
    assert [r[0] for r in df.select(try_int(F.col("y"))).collect()] == [None, 2014, None]
