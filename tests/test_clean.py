"""Cleaning rules: value table in, value table out."""

import pytest
from pyspark.sql import functions as F

from adtally.functions import clean as C


def apply(spark, fn, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_page_id_digits(spark):
    assert apply(spark, C.page_id_digits, ["id:24", "123", "", None, "a1b2"]) == ["24", "123", "", None, "12"]


def test_strip_amount_prefix(spark):
    got = apply(spark, C.strip_amount_prefix, ["≤100", "<= 100", "$250", "-5", "abc", "12d", None])
    assert got == ["100", "100", "250", "5", "", "12d", None]


@pytest.mark.parametrize(
    "raw,want",
    [("100", 100.0), ("100.", 100.0), (".5", 0.5), ("-3", -3.0), (" 77 ", 77.0), ("1e3", 1000.0),
     ("12d", None), ("1,2", None), ("", None), ("0x1A", None), (None, None), ("1f", None)],
)
def test_lenient_number(spark, raw, want):
    assert apply(spark, C.lenient_number, [raw]) == [want]


def test_amount_value(spark):
    got = apply(spark, C.amount_value, ["≤100", "$250", "-5", '1,234', "abc", "", "12d", ".5"])
    # the prefix strip removes a leading dot as well, like the published cleaning rule
    assert got == [100.0, 250.0, 5.0, None, None, None, None, 5.0]


def test_censored(spark):
    got = apply(spark, C.is_censored, ["≤100", "<= 100", "100", None, "$ ≤ 100"])
    assert got == [True, True, False, False, True]


def test_report_date_and_region(spark):
    names = [
        "FacebookAdLibraryReport_2023-06-01_US_last_7_days.zip",
        "x/regions/FacebookAdLibraryReport_2023-06-01_US_last_7_days_New York.csv",
        "FacebookAdLibraryReport_1999-06-01_US_last_7_days.zip",
        "no date here.zip",
    ]
    assert apply(spark, C.report_date, names) == ["2023-06-01", "2023-06-01", None, None]
    got = apply(spark, lambda c: C.region_from_name(c, "last_7_days"), names)
    assert got == [None, "New York", None, None]


def test_period_start(spark):
    got = apply(spark, lambda c: C.period_start(c, 7), ["2023-06-01", "2024-03-01"])
    assert got == ["2023-05-26", "2024-02-24"]
    assert apply(spark, lambda c: C.period_start(c, 1), ["2023-06-01"]) == ["2023-06-01"]


def test_null_if_blank(spark):
    assert apply(spark, C.null_if_blank, ["", "NA", "na", "x", None]) == [None, None, "na", "x", None]


def test_round_to_long(spark):
    assert apply(spark, C.round_to_long, [1.4, 1.5, 2.5, None], "double") == [1, 2, 3, None]
