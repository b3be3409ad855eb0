"""Scalar functions and predicates (X*, F*) and decisions D3, D9, D15, D23."""

import pytest
from pyspark.sql import functions as F

from colonnade.functions import predicates as pr
from colonnade.functions import scalars as sc


@pytest.mark.parametrize("text,ok", [
    ("1999", True), ("12", True), ("0", True), ("-123", True), ("-1", True),
    ("12345", False), ("-", False), ("19a9", False), ("", False), ("-1234", False), ("+12", False),
])
def test_valid_year(spark, text, ok):
    df = spark.createDataFrame([(text,)], "y string")
    assert df.select(pr.is_valid_year("y")).first()[0] is ok


def test_period_label_cases(spark):
    rows = [("2015",), ("2001",), ("1950",), ("",), (None,), ("201",), ("20a0",), ("2020",)]
    df = spark.createDataFrame(rows, "y string")
    got = [r[0] for r in df.select(sc.period_label("y")).collect()]
    assert got == ["Emanuel", "Daly", "Other", "Unknown", "Unknown", "Unknown", "Unknown", "Other"]


def test_string_order_bucket_code_unit_order(spark):
    df = spark.createDataFrame([(a,) for a in ["ZZ Top", "abba", "fog", "kiss", "prince", "u2", "9lives", "Fog"]],
                               "a string")
    got = [r[0] for r in df.select(sc.string_order_bucket("a")).collect()]
    assert got == [0, 0, 1, 2, 3, 4, 0, 0]  # capitals and digits sort before 'f' (D9)
    ci = [r[0] for r in df.select(sc.string_order_bucket("a", case_insensitive=True)).collect()]
    assert ci[0] == 4 and ci[-1] == 1


def test_block_cutoff(spark):
    df = spark.createDataFrame([(b,) for b in [1, 10, 11, 19, 20, 21, 33, 120]], "b int")
    got = [r[0] for r in df.select(sc.block_cutoff("b")).collect()]
    assert got == [0, 0, 10, 10, 10, 20, 30, 110]


# Trade vectors (bar 10 -> bar 1) and their printed EWMA at alpha 0.2.
EWMA_CASES = [
    ([2, 8, 9, 30, 40, 47, 47, 5, -5, -20], 14.230217728),
    ([-51, -40, -41, -72, -94, -62, -32, -34, -9, -26], -45.0882190336),
    ([90, 50, 94, 40, 24, -6, 2, -1, -5, -25], 42.92491776),
    ([-84, -89, -74, -82, -55, -53, -51, -61, -33, -35], -64.167022592),
]


@pytest.mark.parametrize("values,expected", EWMA_CASES)
def test_ewma_fold_reference_vectors(spark, values, expected):
    df = spark.createDataFrame([(values,)], "v array<int>")
    assert df.select(sc.ewma_fold("v", 0.2)).first()[0] == pytest.approx(expected, rel=1e-12)


def test_weight_mass(spark):
    df = spark.createDataFrame([([1, 1, 1],)], "v array<int>")
    assert df.select(sc.weight_mass(3, 0.2)).first()[0] == pytest.approx(0.488)
    assert df.select(sc.ewma_fold("v", 0.2)).first()[0] == pytest.approx(0.488)


def test_misc_scalars(spark):
    df = spark.createDataFrame([("03/15/2019 10:00:00 AM", "NUCHI", 0.0, 2.0)], "d string, w string, z double, x double")
    r = df.select(sc.nth_field("d", "/", 0), sc.contains_ci("w", "chi"), sc.safe_ratio("x", "z"),
                  sc.percent_text(F.lit(0.123456789)), sc.to_int(F.lit("12x")), sc.prefix("w", 2)).first()
    assert tuple(r) == ("03", True, None, "12.345679%", None, "NU")
