from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from panelops.functions import columns as fx


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("name", "want"),
    [(" Clientes Facturados ", "clientes_facturados"), ("E1 (kWh)", "e1_kwh"), ("'mes'", "mes"), ("dmax_mw,,", "dmax_mw")],
)
def test_normalise_name(name, want):
    assert fx.normalise_name(name) == want


@pytest.mark.parametrize(
    ("text", "want"), [("1.5", 1.5), (" 7 ", 7.0), ("abc", None), ("", None), (None, None), ("nan", None), ("1e3", 1000.0)]
)
def test_try_number(spark, text, want):
    assert one(spark, text, fx.try_number) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("2015", 2015), ("2015.0", 2015), ("5.5", None), ("x", None), (None, None), ("9007199254740993", 9007199254740993), ("1e30", None), ("inf", None)],
)
def test_try_integer(spark, text, want):
    assert one(spark, text, fx.try_integer) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("6500,5", 6500.5), ("9000,,", 9000.0), ("160724,5,,", 160724.5), ("5,5", 5.5), ("", None), ("x", None), ("1.5", 1.5)],
)
def test_decimal_comma(spark, text, want):
    assert one(spark, text, fx.decimal_comma) == want


def test_month_date_is_null_per_row(spark):
    rows = spark.createDataFrame([(2020, 1), (2020, 13), (None, 5), (2021, 0), (2019, 12)], "y int, m int")
    got = [r["d"] for r in rows.select(fx.month_date("y", "m").alias("d")).collect()]
    assert got == [dt.date(2020, 1, 1), None, None, None, dt.date(2019, 12, 1)]


def test_parse_date(spark):
    assert one(spark, "31/12/2020", fx.parse_date) == dt.date(2020, 12, 31)
    assert one(spark, "31/02/2020", fx.parse_date) is None


def test_guarded_ratio(spark):
    rows = spark.createDataFrame([(10, 4), (10, 0), (10, -1), (10, None), (None, 4)], "e int, c int")
    got = [r["r"] for r in rows.select(fx.guarded_ratio("e", "c").alias("r")).collect()]
    assert got == [2.5, None, None, None, None]


def test_logs(spark):
    rows = spark.createDataFrame([(100.0,), (0.0,), (-math.e + 1,)], "x double")
    got = rows.select(fx.log10_positive("x").alias("a"), fx.signed_log("x").alias("b")).collect()
    assert [r["a"] for r in got] == [pytest.approx(2.0), None, None]
    assert [r["b"] for r in got] == [pytest.approx(math.log1p(100)), 0.0, pytest.approx(-1.0)]


def test_trim_keeps_null_and_inner_space(spark):
    rows = fx.trim_strings(spark.createDataFrame([("\t a b \n", 1), (None, 2)], "s string, n int")).collect()
    assert [r["s"] for r in rows] == ["a b", None]


def test_nullify_tokens(spark):
    rows = fx.nullify_tokens(spark.createDataFrame([("NA",), ("ok",), ("",), (None,)], "s string")).collect()
    assert [r["s"] for r in rows] == [None, "ok", None, None]


def test_type_suffixes_are_no_numbers_and_short_dates_are_dates(spark):
    from pyspark.sql import functions as F

    from panelops.functions import columns as fx

    df = spark.createDataFrame([("12d",), ("12f",), ("2015d",), (" 1.5e2 ",), ("1/2/2020",), ("01/12/2020",), ("32/1/2020",)], "t string")
    got = df.select(fx.try_number("t").alias("n"), fx.try_integer("t").alias("i"), fx.parse_date("t").cast("string").alias("d")).collect()
    assert [r.n for r in got] == [None, None, None, 150.0, None, None, None]
    assert [r.i for r in got] == [None, None, None, 150, None, None, None]
    assert [r.d for r in got][4:] == ["2020-02-01", "2020-12-01", None] and F is not None
