"""Roll-ups, union by name, totals and day-over-day checks."""

from pyspark.sql import functions as F

from adtally.operators.diagnostics import day_over_day, totals_by_date
from adtally.operators.rollup import clean_records, national_rollup, regional_rollup, union_members

REC = "page_id string, page_name string, disclaimer string, amount_spent string, number_of_ads string, date string, region string"


def test_null_name_is_its_own_group_and_all_null_ads_sum_to_zero(spark):
    df = spark.createDataFrame(
        [
            ("1", None, "D", "100", None, "2021-03-01", "Ohio"),
            ("1", None, "D", "50", None, "2021-03-01", "Ohio"),
            ("1", "P", "D", "≤100", "2", "2021-03-01", "Utah"),
        ],
        REC,
    )
    got = {(r.page_name, r.amt_spent, r.num_of_ads) for r in national_rollup(clean_records(df)).collect()}
    assert got == {(None, 150, 0), ("P", 100, 2)}
    reg = {(r.region, r.amt_spent) for r in regional_rollup(clean_records(df)).collect()}
    assert reg == {("Ohio", 150), ("Utah", 100)}


def test_fractional_sums_round_to_whole(spark):
    df = spark.createDataFrame(
        [("1", "P", "D", "10.4", "1", "2021-03-01", None), ("1", "P", "D", "10.4", "1.5", "2021-03-01", None)],
        REC,
    )
    r = national_rollup(clean_records(df)).collect()[0]
    assert (r.amt_spent, r.num_of_ads) == (21, 3)


def test_union_members_fills_missing_columns(spark):
    a = spark.createDataFrame([("1", "x")], "page_id string, amount_spent string")
    b = spark.createDataFrame([("2", "y", "3")], "page_id string, amount_spent string, number_of_ads string")
    got = sorted(tuple(r) for r in union_members([a, b]).drop().collect())
    assert got == [("1", "x", None), ("2", "y", "3")]


def test_splitting_members_then_union_equals_whole(spark):
    rows = [(str(i % 7), f"P{i % 3}", "D", str(i), "1", "2021-03-01", None) for i in range(200)]
    whole = spark.createDataFrame(rows, REC)
    a, b = whole.filter(F.col("amount_spent").cast("int") % 2 == 0), whole.filter(F.col("amount_spent").cast("int") % 2 == 1)
    one = sorted(tuple(r) for r in national_rollup(clean_records(whole)).collect())
    two = sorted(tuple(r) for r in national_rollup(clean_records(union_members([a, b]))).collect())
    assert one == two


def test_totals_and_day_over_day(spark):
    df = spark.createDataFrame(
        [
            ("a", "d", 100, 10, "1", "2021-03-01"),
            ("b", "d", 100, 10, "2", "2021-03-01"),
            ("a", "d", 100, 10, "1", "2021-03-02"),
            ("a", "d", 500, 30, "1", "2021-03-03"),
        ],
        "page_name string, disclaimer string, amt_spent long, num_of_ads long, page_id string, date string",
    )
    t = totals_by_date(df)
    assert {(r.date, r.total_ads, r.total_spent) for r in t.collect()} == {
        ("2021-03-01", 20, 200), ("2021-03-02", 10, 100), ("2021-03-03", 30, 500),
    }
    d = {r.date: r for r in day_over_day(t, threshold=0.4).collect()}
    assert d["2021-03-01"].flag == "ok" and d["2021-03-01"].prev_date is None
    assert d["2021-03-02"].flag == "drop" and d["2021-03-02"].ads_change == -0.5
    assert d["2021-03-03"].flag == "spike" and d["2021-03-03"].spent_change == 4.0
