"""Target tables, loaded dates, idempotent overwrite, and the kind dimension."""

from adtally.plans.kinds import KINDS, kinds_frame
from adtally.sources.archive import choose_new
from adtally.sources.tables import (
    append,
    create_like,
    create_target,
    loaded_dates,
    loaded_in_all,
    overwrite_dates,
)

SCHEMA = "page_id string, date string, page_name string, disclaimer string, amt_spent long, num_of_ads long"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_create_like_keeps_columns_and_partitioning(spark, fresh_db):
    a, b = f"{fresh_db}.fb_daily_region", f"{fresh_db}.fb_weekly_region"
    create_target(spark, a, regional=True)
    create_like(spark, b, a)
    assert spark.table(b).columns == spark.table(a).columns
    parts = [r for r in spark.sql(f"DESCRIBE TABLE EXTENDED {b}").collect() if r.col_name == "date"]
    assert parts


def test_overwrite_by_name_and_idempotent(spark, fresh_db):
    t = f"{fresh_db}.fb_daily"
    create_target(spark, t)
    day1 = frame(spark, [("1", "2021-03-01", "A", "B", 10, 1)])
    overwrite_dates(day1, t)
    overwrite_dates(day1, t)
    overwrite_dates(frame(spark, [("2", "2021-03-02", "C", "D", 5, 1)]), t)
    got = sorted(tuple(r) for r in spark.table(t).collect())
    assert got == [("A", "B", 10, 1, "1", "2021-03-01"), ("C", "D", 5, 1, "2", "2021-03-02")]
    # replacing one date leaves the others
    overwrite_dates(frame(spark, [("1", "2021-03-01", "A", "B", 99, 1)]), t)
    got = sorted(tuple(r) for r in spark.table(t).collect())
    assert got == [("A", "B", 99, 1, "1", "2021-03-01"), ("C", "D", 5, 1, "2", "2021-03-02")]
    assert sorted(r.date for r in loaded_dates(spark, t).collect()) == ["2021-03-01", "2021-03-02"]


def test_append_adds_rows(spark, fresh_db):
    t = f"{fresh_db}.fb_daily"
    create_target(spark, t)
    day1 = frame(spark, [("1", "2021-03-01", "A", "B", 10, 1)])
    append(day1, t)
    append(day1, t)
    assert spark.table(t).count() == 2


def test_loaded_in_all_needs_every_sink(spark, fresh_db):
    a, b = f"{fresh_db}.a", f"{fresh_db}.b"
    create_target(spark, a)
    create_target(spark, b)
    overwrite_dates(frame(spark, [("1", "2021-03-01", "A", "B", 1, 1), ("1", "2021-03-02", "A", "B", 1, 1)]), a)
    overwrite_dates(frame(spark, [("1", "2021-03-02", "A", "B", 1, 1)]), b)
    assert [r.date for r in loaded_in_all(spark, [a, b]).collect()] == ["2021-03-02"]


def test_choose_new_plans_a_broadcast_anti_join(spark):
    listing = spark.createDataFrame(
        [("/d/x_2021-03-01.zip", "2021-03-01"), ("/d/x_2021-03-02.zip", "2021-03-02")],
        "path string, report_date string",
    ).selectExpr("path", "current_timestamp() AS modificationTime", "report_date")
    loaded = spark.createDataFrame([("2021-03-01",)], "date string")
    out = choose_new(listing, loaded, "2021-01-06")
    assert [r.report_date for r in out.collect()] == ["2021-03-02"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_kind_dimension(spark):
    df = kinds_frame(spark)
    assert df.count() == 6
    by = {r.kind: r for r in df.collect()}
    assert by["90days_region"].floor_date == "2020-02-09"
    assert {r.floor_date for k, r in by.items() if k != "90days_region"} == {"2021-01-06"}
    assert by["lifelong"].clean_page_id is False and by["daily"].clean_page_id is True
    assert sorted(k.target for k in KINDS.values()) == sorted(
        ["fb_daily", "fb_daily_region", "fb_weekly_region", "fb_30days_region", "fb_90days_region", "fb_lifelong"]
    )
