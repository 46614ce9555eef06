"""A hot advertiser (well over a third of all rows) is pre-aggregated before the shuffle."""

from pyspark.sql import functions as F

from adtally.plans.loader import build_report


def test_hot_advertiser_rolls_up_map_side(spark):
    n = 30_000
    ids = spark.range(n).select(
        F.lit("FacebookAdLibraryReport_2021-03-01_US_yesterday.zip").alias("path"),
        F.lit("FacebookAdLibraryReport_2021-03-01_US_yesterday_advertisers.csv").alias("member"),
        (F.col("id") + 1).alias("line_no"),
        # 40 % of the lines belong to advertiser 1, the rest to 1,000 others
        F.when(F.col("id") % 5 < 2, F.lit(1)).otherwise(F.col("id") % 1000 + 2).alias("page"),
    )
    lines = ids.select(
        "path", "member", "line_no",
        F.concat_ws(",", F.col("page").cast("string"), F.lit("P"), F.lit("D"), F.lit("2"), F.lit("1")).alias("line"),
    ).repartition(6)
    report = build_report(lines, "daily")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan  # map-side combine before the exchange
    rows = {r.page_id: (r.amt_spent, r.num_of_ads) for r in report.collect()}
    hot = sum(1 for i in range(n) if i % 5 < 2)
    assert rows["1"] == (2 * hot, hot)
    assert sum(a for a, _ in rows.values()) == 2 * n
