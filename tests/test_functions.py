"""Edge tables for the column helpers, under ANSI on and off."""

import math

from pyspark.sql import functions as F

from larder.functions import (
    bracket_text,
    fill_constant,
    first_char,
    flag_to_double,
    letters_token,
    nan_to_null,
    null_if_empty,
    part_count,
    presence_flag,
    round_half_up,
    title_before_dot,
)


def _apply(spark, fn, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v")).alias("o"), "i").orderBy("i").collect()]


def test_letters_token(spark, ansi):
    got = _apply(spark, letters_token, ["A/5 21171", "STON/O2. 3101282", "113803", None, "PC 17599", ""])
    assert got == ["A", "STON", None, None, "PC", None]


def test_first_char(spark, ansi):
    assert _apply(spark, first_char, ["C85", "", None, "F G73"]) == ["C", "", None, "F"]


def test_part_count(spark, ansi):
    got = _apply(spark, part_count, ["C23 C25 C27", "B96", "", "A  B", None])
    assert got == ["3", "1", "1", "3", "0"]


def test_round_half_up(spark, ansi):
    got = _apply(spark, round_half_up, [0.5, 2.5, -2.5, 1.49, 512.3292, None], "double")
    assert got == [1.0, 3.0, -3.0, 1.0, 512.0, None]


def test_title_before_dot(spark, ansi):
    got = _apply(spark, title_before_dot, ["Braund, Mr. Owen Harris", "Smith, John", None,
                                           "Cumings, Mrs. John Bradley (Florence Briggs Thayer)"])
    assert got == ["Mr", "", None, "Mrs"]


def test_bracket_text_and_flag(spark, ansi):
    names = ["Cumings, Mrs. John (Florence Briggs Thayer)", 'Peel, Mrs. (Lily "May" Peel)',
             "Doe, Mr. (Jean-Paul)", None, "No brackets"]
    assert _apply(spark, bracket_text, names) == ["Florence Briggs Thayer", None, None, None, None]
    assert _apply(spark, lambda c: presence_flag(bracket_text(c)), names) == ["1", "0", "0", "0", "0"]


def test_nan_to_null(spark, ansi):
    got = _apply(spark, nan_to_null, [float("nan"), None, 22.0, 0.5], "double")
    assert got == [None, None, 22.0, 0.5]


def test_null_if_empty(spark, ansi):
    assert _apply(spark, null_if_empty, ["", None, "x", " "]) == [None, None, "x", " "]


def test_fill_and_flag(spark, ansi):
    assert _apply(spark, fill_constant, [None, "S"]) == ["missing", "S"]
    assert _apply(spark, flag_to_double, [None, "1", "0"]) == [0.0, 1.0, 0.0]


def test_helpers_stay_in_codegen(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("v"))
    out = df.select(letters_token("v"), part_count("v"), first_char("v"), presence_flag("v"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "WholeStageCodegen" in plan or "*(" in plan


def test_nan_literal_is_nan(spark):
    (v,) = spark.range(1).select(F.lit(float("nan")).alias("x")).first()
    assert math.isnan(v)
