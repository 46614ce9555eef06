"""Plan properties that the design relies on at scale."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from adtally.operators.partitioning import spread
from adtally.sources.archive import list_archives
from zipfixtures import HEADER_NEW, archive_name, csv_text, national_member, write_zip

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollup_has_one_aggregation_exchange_after_a_partial_aggregate(spark):
    plan = plan_of(entry.q_daily_rollup(spark, SF))
    assert plan.count("ENSURE_REQUIREMENTS") == 1  # the group-by shuffle only
    assert "partial_sum" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = plan_of(entry.q_new_reports(spark, SF))
    assert "GreaterThan(value,450.0)" in plan
    assert "props" not in plan  # the unused column is never read
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_spread_adds_no_shuffle_to_wide_inputs(spark):
    wide = spark.range(0, 1000, numPartitions=16)
    assert "Exchange" not in plan_of(spread(wide, "id"))
    narrow = spark.read.parquet("/root/testdata/sf0.1/events.parquet")  # 2 MB, one row group
    assert "REPARTITION_BY_NUM" in plan_of(spread(narrow, "event_id"))
    tiny = spark.range(0, 10, numPartitions=1)
    assert "Exchange" not in plan_of(spread(tiny, "id"))  # below the size cap


def test_lines_for_archives_read_their_source_once(spark):
    from adtally.plans import report_views as rv

    lifelong = plan_of(rv.lifelong_pair(rv.lineitem_lines(spark, SF)))
    assert lifelong.count("lineitem.parquet") == 1
    pair = plan_of(rv.event_lines(spark, SF, "yesterday", regional=None))
    assert pair.count("events.parquet") == 1


def test_listing_never_reads_archive_contents(spark, tmp_path):
    src = str(tmp_path / "Daily")
    date = "2021-03-01"
    write_zip(os.path.join(src, archive_name("yesterday", date)),
              {national_member("yesterday", date): csv_text(HEADER_NEW, ["1,A,B,1,1"])})
    plan = plan_of(list_archives(spark, src, "daily"))
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]
    assert F  # keep import used
