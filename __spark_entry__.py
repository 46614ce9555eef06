"""

Each query reads the driver's parquet tables and sends report-shaped rows derived from
them through the library's own functions (see ``adtally.plans.report_views``). Each
oracle computes the expected result independently in plain SQL over the same tables.
"""

from __future__ import annotations

import importlib.util
import sys
import time
import uuid
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.errors import PySparkException  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from adtally.functions.clean import (  # noqa: E402
    amount_value,
    base_name,
    is_censored,
    page_id_digits,
    period_start,
    region_from_name,
    report_date,
)
from adtally.operators.diagnostics import (  # noqa: E402
    coverage_gaps,
    day_over_day,
    period_reconcile,
    robust_spikes,
    totals_by_date,
)
from adtally.operators.lines import (  # noqa: E402
    BOM,
    drop_header,
    parse_lines,
    parse_problems,
    split_bom,
)
from adtally.operators.records import join_records  # noqa: E402
from adtally.operators.rollup import union_members  # noqa: E402
from adtally.plans import report_views as rv  # noqa: E402
from adtally.plans.kinds import KINDS, kinds_frame  # noqa: E402
from adtally.plans.loader import build_report, run_batch, run_shared_archives  # noqa: E402
from adtally.session import shared_dir  # noqa: E402
from adtally.sources.append_once import append_once, read_appended  # noqa: E402
from adtally.sources.archive import choose_new, select_archives  # noqa: E402
from adtally.sources.archive_writer import write_archives  # noqa: E402
from adtally.sources.published import PublishedSink, read_published  # noqa: E402
from adtally.sources.tables import (  # noqa: E402
    PathSink,
    append,
    create_like,
    create_target,
    loaded_dates,
    overwrite_dates,
    overwrite_dates_two_sinks,
)
from adtally.streaming.ingest import start_ingest  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
NEW_REPORTS_FLOOR = "2024-01-08"
LOADED_VALUE_OVER = 450
DOD_THRESHOLD = 0.1
# days that bring the events' dates to both sides of the 90-day kind's floor, and the line
# items' months to both sides of the lifelong kind's
NINETY_SHIFT = -1430
LIFELONG_SHIFT = 8766
HALF = "2024-01-15"


# --- queries ---------------------------------------------------------------------------------


def q_name_parse(spark: SparkSession, d: str) -> DataFrame:
    r = rv.event_records(spark, d)
    member = F.concat(
        F.lit("regions/FacebookAdLibraryReport_"), F.col("date"), F.lit("_US_last_7_days_"),
        F.col("disclaimer"), F.lit(" "), F.col("region"), F.lit(".csv"),
    )
    return r.select(
        "event_id",
        report_date(base_name(member)).alias("report_date"),
        region_from_name(member, "last_7_days").alias("region"),
    )


def _text_lines(df: DataFrame, key: str, line_no: F.Column) -> DataFrame:
    return df.select(
        F.lit("texts.zip").alias("path"),
        F.col(key),
        line_no.alias("line_no"),
        F.replace(F.col("text"), F.lit("\n"), F.lit(BOM)).alias("line"),
    )


def q_bom_split(spark: SparkSession, d: str) -> DataFrame:
    docs = rv.table(spark, d, "documents")
    return split_bom(_text_lines(docs, "doc_id", F.lit(1).cast("bigint"))).select(
        "doc_id", "piece", "line"
    )


def q_header_drop(spark: SparkSession, d: str) -> DataFrame:
    conv = rv.table(spark, d, "conversations")
    lines = _text_lines(conv.withColumn("t", F.col("turn")), "conv_id", F.col("t"))
    return drop_header(split_bom(lines)).select(
        "conv_id", F.col("line_no").alias("turn"), "piece", "line"
    )


def q_tolerant_csv(spark: SparkSession, d: str) -> DataFrame:
    p = parse_lines(rv.customer_lines(spark, d, "tolerant"), "new")
    return p.select("page_id", "page_name", "disclaimer", "amount_spent", "number_of_ads", "status")


def q_strict_csv_widths(spark: SparkSession, d: str) -> DataFrame:
    p = parse_lines(rv.customer_lines(spark, d, "widths"), "regional")
    return p.drop("number_of_ads").select(
        "page_id", "page_name", "disclaimer", "amount_spent", "n_fields", "status"
    )


def q_parse_problems(spark: SparkSession, d: str) -> DataFrame:
    return parse_problems(parse_lines(rv.customer_lines(spark, d, "problems"), "new"))


def q_page_id_digits(spark: SparkSession, d: str) -> DataFrame:
    s = rv.table(spark, d, "supplier")
    return s.select("s_suppkey", page_id_digits("s_name").alias("page_id"))


def q_amount_clean(spark: SparkSession, d: str) -> DataFrame:
    a = rv.event_amounts(spark, d)
    return a.select(
        "event_id", "raw", amount_value("raw").alias("amount"),
        amount_value("raw").isNull().alias("amount_invalid"),
    )


def q_censored_flag(spark: SparkSession, d: str) -> DataFrame:
    a = rv.event_amounts(spark, d)
    return a.select("event_id", "raw", is_censored("raw").alias("censored"))


def q_daily_rollup(spark: SparkSession, d: str) -> DataFrame:
    return build_report(rv.event_lines(spark, d, "yesterday", regional=False), "daily")


def q_regional_rollup(spark: SparkSession, d: str) -> DataFrame:
    return build_report(rv.event_lines(spark, d, "last_7_days", regional=True), "weekly_region")


def q_lifelong_rollup(spark: SparkSession, d: str) -> DataFrame:
    return build_report(rv.lineitem_lines(spark, d), "lifelong")


def q_distinct_dates(spark: SparkSession, d: str) -> DataFrame:
    return loaded_dates(spark, _written_daily(spark, d, "distinct_dates"))


def q_strict_csv(spark: SparkSession, d: str) -> DataFrame:
    p = parse_lines(rv.customer_lines(spark, d, "strict"), "regional", repair_quotes=False)
    return p.select("page_id", "page_name", "amount_spent", "number_of_ads", "n_fields", "status")


def q_old_layout(spark: SparkSession, d: str) -> DataFrame:
    p = parse_lines(rv.customer_lines(spark, d, "old"), "old")
    return p.select("page_id", "page_name", "disclaimer", "amount_spent", "number_of_ads", "status")


def q_rollup_bad_values(spark: SparkSession, d: str) -> DataFrame:
    return build_report(rv.event_bad_lines(spark, d), "daily")


def q_kind_of_file(spark: SparkSession, d: str) -> DataFrame:
    """Report files named after events, joined to the kinds by their archive patterns."""
    e = rv.table(spark, d, "events")
    label = F.element_at(F.array(*map(F.lit, ["yesterday", "last_7_days", "last_30_days", "last_90_days", "lifelong", "monthly"])), (F.col("event_id") % 6 + 1).cast("int"))
    name = F.concat(F.lit("FacebookAdLibraryReport_"), F.date_format("ts", "yyyy-MM-dd"), F.lit("_US_"), label, F.lit(".zip"))
    files = e.select("event_id", name.alias("name"))
    kinds = kinds_frame(spark).select("kind", "archive_regex", "days")
    return files.join(F.broadcast(kinds), F.expr("name rlike archive_regex")).select(
        "event_id", "kind", period_start(report_date("name"), F.col("days").cast("int")).alias("first_day")
    )


def q_new_reports(spark: SparkSession, d: str) -> DataFrame:
    listing = select_archives(rv.event_archive_listing(spark, d), "daily")
    e = rv.table(spark, d, "events")
    loaded = (
        e.filter(F.col("value") > LOADED_VALUE_OVER)
        .select(F.date_format("ts", "yyyy-MM-dd").alias("date"))
        .distinct()
    )
    return choose_new(listing, loaded, NEW_REPORTS_FLOOR).select("report_date", "path")


def q_region_union(spark: SparkSession, d: str) -> DataFrame:
    # the whole table twice: once in the 4-column regional layout, once in the 5-column one
    r = rv.event_records(spark, d)
    four = r.select("event_id", "page_id", "region", "amount_spent")
    five = r.select("event_id", "page_id", "region", "amount_spent", "number_of_ads")
    return union_members([four, five])


def q_coverage_period(spark: SparkSession, d: str) -> DataFrame:
    dates = rv.event_records(spark, d).select("date").distinct()
    return dates.select(
        "date",
        period_start("date", 7).alias("start_7"),
        period_start("date", 30).alias("start_30"),
        period_start("date", 90).alias("start_90"),
    )


def q_totals_by_date(spark: SparkSession, d: str) -> DataFrame:
    return totals_by_date(q_daily_rollup(spark, d))


def q_day_over_day(spark: SparkSession, d: str) -> DataFrame:
    return day_over_day(q_totals_by_date(spark, d), threshold=DOD_THRESHOLD)


def q_first_member(spark: SparkSession, d: str) -> DataFrame:
    names = rv.event_member_names(spark, d)
    wanted = names.filter(F.col("member").rlike(KINDS["lifelong"].member_regex))
    return wanted.groupBy("date").agg(F.min("member").alias("first_member"))


def _scratch(spark: SparkSession, name: str) -> tuple[str, str]:
    tag = f"{name}_{uuid.uuid4().hex[:10]}"
    return f"adtally_{tag}", shared_dir(spark, "adtally", tag)


def _target(spark: SparkSession, name: str, regional: bool = False) -> str:
    table, folder = _scratch(spark, name)
    create_target(spark, table, regional=regional, location=folder)
    return table


def _written_daily(spark: SparkSession, d: str, name: str) -> str:
    table = _target(spark, name)
    overwrite_dates(q_daily_rollup(spark, d), table)
    return table


def q_table_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return spark.table(_written_daily(spark, d, "round_trip"))


def q_append_table(spark: SparkSession, d: str) -> DataFrame:
    """Two appends, of either half of the days, give the whole table."""
    table = _target(spark, "append")
    report = q_daily_rollup(spark, d)
    append(report.filter(F.col("date") < HALF), table)
    append(report.filter(F.col("date") >= HALF), table)
    return spark.table(table)


def q_table_like(spark: SparkSession, d: str) -> DataFrame:
    """The regional report in a table made like another kind's target."""
    first = _target(spark, "like_first", regional=True)
    second, folder = _scratch(spark, "like_second")
    create_like(spark, second, first, location=folder)
    overwrite_dates(q_regional_rollup(spark, d), second)
    return spark.table(second)


def q_two_sinks(spark: SparkSession, d: str) -> DataFrame:
    first, second = _target(spark, "sink_one"), _target(spark, "sink_two")
    report = q_daily_rollup(spark, d)
    # the report dates are the event days (one row per day), as a loader knows them from
    # its archive listing: the report itself is computed only once, by the first write
    days = rv.event_records(spark, d).select("date").distinct()
    overwrite_dates_two_sinks(report, first, second, [r.date for r in days.collect()])
    return spark.table(second)


def q_reload_idempotent(spark: SparkSession, d: str) -> DataFrame:
    table = _written_daily(spark, d, "reload")
    overwrite_dates(q_daily_rollup(spark, d), table)
    return spark.table(table)


def _archives(spark: SparkSession, lines: DataFrame, name: str, folder: str | None = None) -> str:
    folder = folder or _scratch(spark, name)[1]
    named = lines.withColumnRenamed("path", "archive")
    written = write_archives(named, folder, header_of=rv.header_of, extra=rv.NOTES)
    written.collect()  # one row per archive written
    return folder


def _load_archives(spark: SparkSession, kind: str, lines: DataFrame, reader: str = "archive") -> DataFrame:
    folder = _archives(spark, lines, f"archives_{kind}")
    table = _target(spark, f"table_{kind}", regional=KINDS[kind].regional)
    run_batch(spark, kind, folder, target=table, reader=reader)
    return spark.table(table)


def q_archive_daily(spark: SparkSession, d: str) -> DataFrame:
    return _load_archives(spark, "daily", rv.event_lines(spark, d, "yesterday", regional=False))


def _daily_pair(spark: SparkSession, d: str) -> DataFrame:
    """Daily archives hold the national member and the regional ones."""
    return rv.event_lines(spark, d, "yesterday", regional=None)


def q_archive_daily_region(spark: SparkSession, d: str) -> DataFrame:
    return _load_archives(spark, "daily_region", _daily_pair(spark, d))


def q_shared_daily(spark: SparkSession, d: str) -> DataFrame:
    folder = _archives(spark, _daily_pair(spark, d), "archives_shared")
    n, r = _target(spark, "shared_n"), _target(spark, "shared_r", regional=True)
    run_shared_archives(spark, folder, {"daily": n, "daily_region": r})
    return union_members([spark.table(n), spark.table(r)])


def q_archive_regional(spark: SparkSession, d: str) -> DataFrame:
    return _load_archives(spark, "weekly_region", rv.event_lines(spark, d, "last_7_days", regional=True))


def q_archive_regional_members(spark: SparkSession, d: str) -> DataFrame:
    # many region members per archive: one task per (archive, member)
    lines = rv.event_lines(spark, d, "last_7_days", regional=True)
    return _load_archives(spark, "weekly_region", lines, reader="members")


def q_archive_30days(spark: SparkSession, d: str) -> DataFrame:
    return _load_archives(spark, "30days_region", rv.event_lines(spark, d, "last_30_days", regional=True))


def q_archive_90days(spark: SparkSession, d: str) -> DataFrame:
    lines = rv.event_lines(spark, d, "last_90_days", regional=True, shift_days=NINETY_SHIFT)
    return _load_archives(spark, "90days_region", lines)


def q_archive_lifelong(spark: SparkSession, d: str) -> DataFrame:
    """Two candidate members an archive, two sinks; the second sink's rows."""
    lines = rv.lifelong_pair(rv.lineitem_lines(spark, d, LIFELONG_SHIFT))
    folder = _archives(spark, lines, "archives_lifelong")
    first = _target(spark, "lifelong_one")
    second = PathSink(_scratch(spark, "lifelong_two")[1], "orc")
    run_batch(spark, "lifelong", folder, target=first, second_target=second)
    stored = spark.read.orc(second.path)
    return stored.withColumn("date", F.col("date").cast("string"))


def q_load_twice(spark: SparkSession, d: str) -> DataFrame:
    """Half of the days are loaded, then all: the second load adds the other half only."""
    lines = rv.event_lines(spark, d, "yesterday", regional=False)
    table = _target(spark, "load_twice")
    half = lines.filter(F.col("path") < f"FacebookAdLibraryReport_{HALF}")
    folder = _archives(spark, half, "archives_twice")
    run_batch(spark, "daily", folder, target=table)
    rest = lines.filter(F.col("path") >= f"FacebookAdLibraryReport_{HALF}")
    _archives(spark, rest, "archives_twice", folder)
    run_batch(spark, "daily", folder, target=table)
    return spark.table(table)


def q_load_problems(spark: SparkSession, d: str) -> DataFrame:
    """Customers as one archive of a member for each market segment, with its parse problems."""
    lines = rv.customer_lines(spark, d, "problems").select(
        F.lit("FacebookAdLibraryReport_2021-03-01_US_last_7_days.zip").alias("path"),
        F.concat(F.lit("regions/FacebookAdLibraryReport_2021-03-01_US_last_7_days_"), F.col("member"), F.lit(".csv")).alias("member"),
        "line_no", "line",
    )
    folder = _archives(spark, lines, "archives_problems")
    table = _target(spark, "problems_table", regional=True)
    problems = PathSink(_scratch(spark, "problems")[1])
    run_batch(spark, "weekly_region", folder, target=table, problems=problems)
    return spark.read.parquet(problems.path).select(
        base_name("member").alias("member"), "status", "amount_invalid", "n_records"
    )


def q_stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    folder = _archives(spark, rv.event_lines(spark, d, "yesterday", regional=False), "stream_source")
    table = _target(spark, "stream_target")
    _, checkpoint = _scratch(spark, "stream_checkpoint")
    query = start_ingest(spark, "daily", folder, checkpoint, target=table)
    query.awaitTermination()
    return spark.table(table)


def q_stream_redownload(spark: SparkSession, d: str) -> DataFrame:
    """Every date comes twice, the later copy with the right amounts; one file a micro-batch."""
    lines = rv.event_lines(spark, d, "yesterday", regional=False)
    _, folder = _scratch(spark, "stream_twice")
    early = lines.filter(F.col("line_no") % 2 == 0)
    _archives(spark, early, "", f"{folder}/a")
    time.sleep(1.1)  # file systems may keep whole seconds
    _archives(spark, lines, "", f"{folder}/b")
    table = _target(spark, "stream_twice_target")
    _, checkpoint = _scratch(spark, "stream_twice_checkpoint")
    query = start_ingest(spark, "daily", f"{folder}/*", checkpoint, target=table, max_files_per_trigger=8)
    query.awaitTermination()
    return spark.table(table)


def _before_half():
    return F.col("path") < f"FacebookAdLibraryReport_{HALF}"


def _emptied(spark: SparkSession, d: str, name: str, **sinks) -> None:
    """All days are loaded, then newer copies of the first half that hold a header only; both twice."""
    lines = rv.event_lines(spark, d, "yesterday", regional=False)
    folder = _archives(spark, lines, f"archives_{name}")
    run_batch(spark, "daily", folder, **sinks)
    time.sleep(1.1)  # file systems may keep whole seconds
    _archives(spark, rv.downloaded_again(rv.blank_lines(lines.filter(_before_half()))), "", folder)
    run_batch(spark, "daily", folder, **sinks)
    if again := run_batch(spark, "daily", folder, **sinks):
        raise AssertionError(f"loaded twice: {again}")


def q_load_emptied(spark: SparkSession, d: str) -> DataFrame:
    table = _target(spark, "emptied")
    _emptied(spark, d, "emptied", target=table)
    return spark.table(table)


def q_load_published(spark: SparkSession, d: str) -> DataFrame:
    """The same through two published folders with one manifest; the second one's rows."""
    log = _scratch(spark, "published_log")[1]
    one, two = (PublishedSink(_scratch(spark, f"published_{n}")[1], log) for n in ("one", "two"))
    _emptied(spark, d, "published", target=one, second_target=two)
    return read_published(spark, two)


def q_stream_emptied(spark: SparkSession, d: str) -> DataFrame:
    """Every date comes with its rows, and those of the first half again with a header only."""
    lines = rv.event_lines(spark, d, "yesterday", regional=False)
    _, folder = _scratch(spark, "stream_emptied")
    _archives(spark, lines, "", f"{folder}/a")
    time.sleep(1.1)
    _archives(spark, rv.blank_lines(lines.filter(_before_half())), "", f"{folder}/b")
    table = _target(spark, "stream_emptied_target")
    _, checkpoint = _scratch(spark, "stream_emptied_checkpoint")
    start_ingest(spark, "daily", f"{folder}/*", checkpoint, target=table, max_files_per_trigger=16).awaitTermination()
    return spark.table(table)


def q_load_guards(spark: SparkSession, d: str) -> DataFrame:
    """Archives without a report of the kind are rejected, the others load; then nothing is new."""
    lines = rv.event_lines(spark, d, "yesterday", regional=False)
    other = F.when(_before_half(), F.col("member")).otherwise(F.lit("regions/notes.txt"))
    folder = _archives(spark, lines.withColumn("member", other), "archives_guards")
    table = _target(spark, "guards")
    first = run_batch(spark, "daily", folder, target=table, on_reject="return")
    second = run_batch(spark, "daily", folder, target=table, on_reject="return")
    rejected = spark.createDataFrame([(r[0],) for r in second.rejected], "path string").select(
        report_date(base_name("path")).alias("date"), F.lit("rejected").alias("state")
    )
    loaded = spark.createDataFrame([(x,) for x in first], "date string").withColumn("state", F.lit("loaded"))
    rows = spark.table(table).groupBy("date").agg(F.count("*").alias("n_rows"))
    return loaded.unionByName(rejected).unionByName(
        spark.createDataFrame([(x, "loaded again") for x in second], "date string, state string")
    ).join(rows, "date", "left")


def q_append_once(spark: SparkSession, d: str) -> DataFrame:
    """Two batches; the first one's tasks fail after writing, then both are sent twice."""
    folder = _scratch(spark, "append_once")[1]
    report = q_daily_rollup(spark, d)

    def lost(batches):
        yield from batches
        raise RuntimeError("lost after writing")

    halves = {"first": report.filter(F.col("date") < HALF), "second": report.filter(F.col("date") >= HALF)}
    try:
        append_once(halves["first"].mapInArrow(lost, report.schema), folder, "first")
    except PySparkException as e:
        if "lost after writing" not in str(e):
            raise
    for _ in range(2):
        for batch, rows in halves.items():
            append_once(rows, folder, batch)
    return read_appended(spark, folder)


def q_realigned_csv(spark: SparkSession, d: str) -> DataFrame:
    p = parse_lines(rv.customer_lines(spark, d, "wide"), "new", realign=True)
    return p.select("page_id", "page_name", "disclaimer", "amount_spent", "number_of_ads", "status")


def q_multiline_csv(spark: SparkSession, d: str) -> DataFrame:
    records = join_records(rv.customer_broken_lines(spark, d))
    p = parse_lines(records, "new", repair_quotes=False)
    return p.select("page_id", "page_name", "disclaimer", "amount_spent", "number_of_ads", "status")


def q_censored_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Bounds of the spend that a load writes beside its rows."""
    folder = _archives(spark, rv.event_lines(spark, d, "yesterday", regional=False), "archives_bounds")
    bounds = PathSink(_scratch(spark, "bounds")[1])
    run_batch(spark, "daily", folder, target=_target(spark, "bounds_target"), bounds=bounds)
    return spark.read.parquet(bounds.path).withColumn("date", F.col("date").cast("string"))


def q_kept_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals kept by loads: all days, then the first half's emptied copies."""
    totals = PathSink(_scratch(spark, "kept_totals")[1])
    _emptied(spark, d, "totals", target=_target(spark, "totals_target"), totals=totals)
    return spark.read.parquet(totals.path).withColumn("date", F.col("date").cast("string"))


def _weekly_reports(spark: SparkSession, d: str) -> DataFrame:
    """Report dates by event type: those of large values, which leave days uncovered."""
    e = rv.table(spark, d, "events")
    rare = e.filter((F.col("value") > 200) & (F.dayofmonth("ts") % 7 < 2))
    return rare.select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("date"))


def q_coverage_gaps(spark: SparkSession, d: str) -> DataFrame:
    return coverage_gaps(_weekly_reports(spark, d), 3, ("event_type",))


def _by_region(records: DataFrame) -> DataFrame:
    return records.groupBy("region", "date").agg(F.sum(amount_value("amount_spent")).cast("bigint").alias("total_spent"))


def q_period_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Seven-day totals that miss some records, against the days; region R0 has no Mondays."""
    r = rv.event_records(spark, d)
    daily = _by_region(r.filter((F.col("region") != "R0") | (F.dayofweek(F.to_date("date")) != 2)))
    ends = r.select(F.to_date("date").alias("end")).distinct()
    kept = r.filter((F.col("event_id") % 997 != 0) | (F.col("region") == "R1"))
    week = kept.withColumn("end", F.explode(F.sequence(F.to_date("date"), F.date_add(F.to_date("date"), 6))))
    period = _by_region(week.join(F.broadcast(ends), "end", "left_semi").withColumn("date", F.date_format("end", "yyyy-MM-dd")))
    return period_reconcile(period, daily, 7, ("region",))


def q_robust_spikes(spark: SparkSession, d: str) -> DataFrame:
    return robust_spikes(_by_region(rv.event_records(spark, d)), ("region",), history_days=28, min_history=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "name_parse": q_name_parse,
    "bom_split": q_bom_split,
    "header_drop": q_header_drop,
    "tolerant_csv": q_tolerant_csv,
    "strict_csv_widths": q_strict_csv_widths,
    "strict_csv": q_strict_csv,
    "old_layout": q_old_layout,
    "parse_problems": q_parse_problems,
    "page_id_digits": q_page_id_digits,
    "amount_clean": q_amount_clean,
    "censored_flag": q_censored_flag,
    "daily_rollup": q_daily_rollup,
    "regional_rollup": q_regional_rollup,
    "lifelong_rollup": q_lifelong_rollup,
    "rollup_bad_values": q_rollup_bad_values,
    "kind_of_file": q_kind_of_file,
    "distinct_dates": q_distinct_dates,
    "new_reports": q_new_reports,
    "region_union": q_region_union,
    "coverage_period": q_coverage_period,
    "totals_by_date": q_totals_by_date,
    "day_over_day": q_day_over_day,
    "first_member": q_first_member,
    "table_round_trip": q_table_round_trip,
    "append_table": q_append_table,
    "table_like": q_table_like,
    "two_sinks": q_two_sinks,
    "reload_idempotent": q_reload_idempotent,
    "archive_daily": q_archive_daily,
    "archive_regional": q_archive_regional,
    "archive_regional_members": q_archive_regional_members,
    "archive_daily_region": q_archive_daily_region,
    "shared_daily": q_shared_daily,
    "archive_30days": q_archive_30days,
    "archive_90days": q_archive_90days,
    "archive_lifelong": q_archive_lifelong,
    "load_twice": q_load_twice,
    "load_problems": q_load_problems,
    "stream_ingest": q_stream_ingest,
    "stream_redownload": q_stream_redownload,
    "load_emptied": q_load_emptied,
    "load_published": q_load_published,
    "stream_emptied": q_stream_emptied,
    "load_guards": q_load_guards,
    "append_once": q_append_once,
    "realigned_csv": q_realigned_csv,
    "multiline_csv": q_multiline_csv,
    "censored_bounds": q_censored_bounds,
    "kept_totals": q_kept_totals,
    "coverage_gaps": q_coverage_gaps,
    "period_reconcile": q_period_reconcile,
    "robust_spikes": q_robust_spikes,
}


QUERY_OPERATORS: dict[str, tuple[str, ...]] = {
    "name_parse": ("C8", "C9"),
    "bom_split": ("C1", "S5"),
    "header_drop": ("P3", "C1"),
    "tolerant_csv": ("S6", "C2", "P2", "U2"),
    "strict_csv_widths": ("P2", "P4"),
    "strict_csv": ("S7", "P2", "P4", "U2"),
    "old_layout": ("P2", "S6"),
    "parse_problems": ("C12", "L5", "L6", "L11"),
    "page_id_digits": ("C3",),
    "amount_clean": ("C4", "C5"),
    "censored_flag": ("C11",),
    "daily_rollup": ("E1", "A1", "C1", "C2", "C3", "C4", "C5", "P3", "P7", "S6"),
    "regional_rollup": ("E2", "A2", "C9", "P7"),
    "lifelong_rollup": ("A3", "L20"),
    "rollup_bad_values": ("A1", "A5", "C5", "C6"),
    "kind_of_file": ("S13", "C8", "C10"),
    "distinct_dates": ("A4", "S8"),
    "new_reports": ("J1", "P5", "P6", "L17"),
    "region_union": ("U1",),
    "coverage_period": ("C10",),
    "totals_by_date": ("A6",),
    "day_over_day": ("W1", "A6"),
    "first_member": ("S3",),
    "table_round_trip": ("S11", "P1"),
    "append_table": ("S9", "S11"),
    "table_like": ("S12",),
    "two_sinks": ("S10", "L18"),
    "reload_idempotent": ("T2",),
    "archive_daily": ("S1", "S2", "S3", "S5", "E1"),
    "archive_daily_region": ("S1", "S2", "S3", "E2"),
    "shared_daily": ("S1", "S2", "S3", "E1", "E2"),
    "archive_regional": ("S1", "S2", "S3", "E2"),
    "archive_regional_members": ("S2", "S3", "E2"),
    "archive_30days": ("S1", "S3", "E2"),
    "archive_90days": ("S1", "S3", "E2", "P5"),
    "archive_lifelong": ("S1", "S2", "S4", "O1", "S10", "P5", "E3"),
    "load_twice": ("E1", "J1", "P6", "S8", "T2"),
    "load_problems": ("C12", "L5"),
    "stream_ingest": ("T1", "S1", "S2"),
    "stream_redownload": ("T1", "T2"),
    "load_emptied": ("E1", "T2", "P8"),
    "load_published": ("S10", "L18", "T2"),
    "stream_emptied": ("T1", "T2"),
    "load_guards": ("P8", "S3", "E1"),
    "append_once": ("S9",),
    "realigned_csv": ("C2", "L5", "U2"),
    "multiline_csv": ("S7", "L9"),
    "censored_bounds": ("C11", "E1"),
    "kept_totals": ("A6", "T2"),
    "coverage_gaps": ("C10", "W1"),
    "period_reconcile": ("C10", "W1"),
    "robust_spikes": ("W1",),
}


# --- oracles ---------------------------------------------------------------------------------

_WHOLE = "CAST(CAST(floor({0}) AS BIGINT) AS VARCHAR)"

_EVENT_RECORDS = f"""
  SELECT event_id,
         CAST(user_id AS VARCHAR) AS page_id,
         'page ' || CAST(user_id AS VARCHAR) AS page_name,
         CASE WHEN event_id % 7 = 0 THEN 'Friends of ' || event_type || '” PAC'
              ELSE event_type END AS disclaimer,
         CASE WHEN event_id % 7 = 0 THEN 'Friends of "' || event_type || '” PAC'
              ELSE event_type END AS disclaimer_text,
         CASE WHEN value <= 20 THEN '≤100' ELSE {_WHOLE.format('value')} END AS amount_text,
         CASE WHEN value <= 20 THEN 100 ELSE floor(value) END AS amount,
         event_id % 4 AS ads,
         CAST(event_id % 4 AS VARCHAR) AS ads_text,
         strftime(ts, '%Y-%m-%d') AS date,
         'R' || CAST(event_id % 5 AS VARCHAR) AS region
  FROM events
"""

_DAILY = f"""
  WITH r AS ({_EVENT_RECORDS})
  SELECT page_name, disclaimer, CAST(SUM(amount) AS BIGINT) AS amt_spent,
         CAST(SUM(ads) AS BIGINT) AS num_of_ads, page_id, date
  FROM r GROUP BY page_name, disclaimer, page_id, date
"""

_REGIONAL = f"""
  WITH r AS ({_EVENT_RECORDS})
  SELECT page_name, disclaimer, CAST(SUM(amount) AS BIGINT) AS amt_spent, region, page_id, date
  FROM r GROUP BY page_name, disclaimer, page_id, date, region
"""

def _regional_shifted(days: int, floor: str) -> str:
    moved = _EVENT_RECORDS.replace("strftime(ts, '%Y-%m-%d')", f"strftime(CAST(ts AS DATE) + {days}, '%Y-%m-%d')")
    return f"""
        WITH r AS ({moved})
        SELECT page_name, disclaimer, CAST(SUM(amount) AS BIGINT) AS amt_spent, region, page_id, date
        FROM r WHERE date >= '{floor}' GROUP BY page_name, disclaimer, page_id, date, region"""


_LIFELONG = """
  SELECT s_name AS page_name, 'Paid by ' || l_returnflag || l_linestatus AS disclaimer,
         CAST(SUM(floor(l_extendedprice)) AS BIGINT) AS amt_spent,
         CAST(SUM(floor(l_quantity)) AS BIGINT) AS num_of_ads,
         'id:' || CAST(l_suppkey AS VARCHAR) AS page_id,
         strftime(date_trunc('month', CAST(l_shipdate AS DATE) + 10227), '%Y-%m-%d') AS date
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY ALL
"""

_AMOUNTS = f"""
  SELECT event_id,
         CASE event_id % 6
           WHEN 0 THEN CASE WHEN value <= 20 THEN '≤100' ELSE {_WHOLE.format('value')} END
           WHEN 1 THEN '$' || {_WHOLE.format('value')}
           WHEN 2 THEN '<= 100'
           WHEN 3 THEN {_WHOLE.format('value')} || 'd'
           WHEN 4 THEN {_WHOLE.format('value')} || ',000'
           ELSE '-' || {_WHOLE.format('value')} END AS raw
  FROM events
"""

_NUMBER_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

_TOTALS = f"""
  WITH r AS ({_EVENT_RECORDS})
  SELECT date, CAST(SUM(ads) AS BIGINT) AS total_ads, CAST(SUM(amount) AS BIGINT) AS total_spent
  FROM r GROUP BY date
"""

_SPLIT_TEXT = """
  SELECT {key}, {line_no}, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS piece,
         unnest(l) AS line
  FROM (SELECT {key}, {line_no}, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS l
        FROM {table})
"""

ORACLES: dict[str, str] = {
    "name_parse": f"""
        WITH r AS ({_EVENT_RECORDS}),
        m AS (SELECT event_id, 'regions/FacebookAdLibraryReport_' || date || '_US_last_7_days_'
                     || disclaimer_text || ' ' || region || '.csv' AS member FROM r)
        SELECT event_id,
               regexp_extract(member, '20[12][0-9]-[0-9]{{2}}-[0-9]{{2}}', 0) AS report_date,
               regexp_extract(member, 'last_7_days_(.+)\\.csv$', 1) AS region
        FROM m""",
    "bom_split": "SELECT doc_id, piece, line FROM ("
    + _SPLIT_TEXT.format(key="doc_id", line_no="1 AS line_no", table="documents")
    + ")",
    "header_drop": "SELECT conv_id, turn, piece, line FROM ("
    + _SPLIT_TEXT.format(key="conv_id", line_no="turn", table="conversations")
    + ") WHERE NOT (turn = 0 AND piece = 0)",
    "tolerant_csv": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS page_id, c_name AS page_name,
               CASE c_custkey % 4
                 WHEN 0 THEN 'Friends of ' || c_mktsegment || '” Fund'
                 WHEN 1 THEN 'Open ' || c_mktsegment
                 WHEN 2 THEN c_mktsegment || ', Inc'
                 ELSE 'Say "' || c_mktsegment || '", now' END AS disclaimer,
               {_WHOLE.format('c_acctbal')} AS amount_spent,
               CAST(c_nationkey AS VARCHAR) AS number_of_ads,
               CASE WHEN c_custkey % 4 IN (0, 1) THEN 'quote_stripped' ELSE 'ok' END AS status
        FROM customer""",
    "strict_csv_widths": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS page_id, c_name AS page_name,
               c_mktsegment AS disclaimer, {_WHOLE.format('c_acctbal')} AS amount_spent,
               CASE WHEN c_custkey % 2 = 0 THEN 4 ELSE 5 END AS n_fields, 'ok' AS status
        FROM customer""",
    "parse_problems": """
        SELECT 'customers.zip' AS path, c_mktsegment AS member,
               CASE c_custkey % 5 WHEN 0 THEN 'short' WHEN 1 THEN 'long'
                    WHEN 2 THEN 'quote_stripped' ELSE 'ok' END AS status,
               c_custkey % 5 IN (0, 3) AS amount_invalid,
               CAST(count(*) AS BIGINT) AS n_records
        FROM customer GROUP BY ALL""",
    "page_id_digits": """
        SELECT s_suppkey, regexp_replace(s_name, '[^0-9]', '', 'g') AS page_id FROM supplier""",
    "amount_clean": f"""
        WITH a AS ({_AMOUNTS}),
        s AS (SELECT event_id, raw, regexp_replace(raw, '^[^0-9]+', '') AS t FROM a)
        SELECT event_id, raw,
               CASE WHEN regexp_matches(t, '{_NUMBER_RE}') THEN CAST(trim(t) AS DOUBLE) END AS amount,
               NOT regexp_matches(t, '{_NUMBER_RE}') AS amount_invalid
        FROM s""",
    "censored_flag": f"""
        WITH a AS ({_AMOUNTS})
        SELECT event_id, raw, regexp_matches(raw, '^[^0-9]*[≤<]') AS censored FROM a""",
    "daily_rollup": _DAILY,
    "regional_rollup": _REGIONAL,
    "lifelong_rollup": _LIFELONG,
    "distinct_dates": "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date FROM events",
    "new_reports": f"""
        WITH l AS (
          SELECT '/reports/' || event_type || '/FacebookAdLibraryReport_'
                 || strftime(ts, '%Y-%m-%d') || '_US_yesterday.zip' AS path,
                 strftime(ts, '%Y-%m-%d') AS report_date, max(ts) AS mt
          FROM events GROUP BY 1, 2),
        loaded AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS d FROM events
                   WHERE value > {LOADED_VALUE_OVER})
        SELECT report_date, arg_max(path, mt) AS path FROM l
        WHERE report_date >= '{NEW_REPORTS_FLOOR}' AND report_date NOT IN (SELECT d FROM loaded)
        GROUP BY report_date""",
    "region_union": f"""
        WITH r AS ({_EVENT_RECORDS})
        SELECT event_id, page_id, region, amount_text AS amount_spent,
               CAST(NULL AS VARCHAR) AS number_of_ads FROM r
        UNION ALL
        SELECT event_id, page_id, region, amount_text AS amount_spent, ads_text AS number_of_ads
        FROM r""",
    "coverage_period": """
        SELECT date,
               strftime(CAST(date AS DATE) - 6, '%Y-%m-%d') AS start_7,
               strftime(CAST(date AS DATE) - 29, '%Y-%m-%d') AS start_30,
               strftime(CAST(date AS DATE) - 89, '%Y-%m-%d') AS start_90
        FROM (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date FROM events)""",
    "totals_by_date": _TOTALS,
    "day_over_day": f"""
        WITH t AS ({_TOTALS}),
        l AS (SELECT date, total_ads, total_spent,
                     lag(date) OVER (ORDER BY date) AS prev_date,
                     lag(total_ads) OVER (ORDER BY date) AS prev_ads,
                     lag(total_spent) OVER (ORDER BY date) AS prev_spent
              FROM t),
        c AS (SELECT *,
                     CASE WHEN prev_ads <> 0 THEN (total_ads - prev_ads) / prev_ads END AS ads_change,
                     CASE WHEN prev_spent <> 0 THEN (total_spent - prev_spent) / prev_spent END
                       AS spent_change
              FROM l)
        SELECT *,
               CASE WHEN least(ads_change, spent_change) <= -{DOD_THRESHOLD} THEN 'drop'
                    WHEN greatest(ads_change, spent_change) >= {DOD_THRESHOLD} THEN 'spike'
                    ELSE 'ok' END AS flag
        FROM c""",
    "first_member": """
        WITH n AS (
          SELECT strftime(ts, '%Y-%m-%d') AS date,
                 CASE event_id % 3
                   WHEN 0 THEN 'FacebookAdLibraryReport_' || strftime(ts, '%Y-%m-%d') || '_'
                               || event_type || '_US_lifelong_advertisers.csv'
                   WHEN 1 THEN 'FacebookAdLibraryReportRevamp_' || strftime(ts, '%Y-%m-%d') || '_'
                               || event_type || '_US_lifelong_advertisers.csv'
                   ELSE 'readme_' || event_type || '.txt' END AS member
          FROM events)
        SELECT date, min(member) AS first_member FROM n
        WHERE regexp_matches(member,
                '^FacebookAdLibraryReport(Revamp)?_.*_US_lifelong_advertisers\\.csv$')
        GROUP BY date""",
    "table_round_trip": _DAILY,
    "two_sinks": _DAILY,
    "reload_idempotent": _DAILY,
    "archive_daily": _DAILY,
    "archive_regional": _REGIONAL,
    "archive_regional_members": _REGIONAL,
    "archive_daily_region": _REGIONAL,
    "shared_daily": f"""
        SELECT page_name, disclaimer, amt_spent, num_of_ads, page_id, date, CAST(NULL AS VARCHAR) AS region FROM ({_DAILY})
        UNION ALL
        SELECT page_name, disclaimer, amt_spent, NULL AS num_of_ads, page_id, date, region FROM ({_REGIONAL})""",
    "archive_30days": _REGIONAL,
    # the batch load applies the kind's start-date floor
    "archive_90days": _regional_shifted(NINETY_SHIFT, KINDS["90days_region"].floor_date),
    "archive_lifelong": f"""
        SELECT * FROM ({_LIFELONG.replace("10227", str(LIFELONG_SHIFT))})
        WHERE date >= '{KINDS["lifelong"].floor_date}'""",
    "load_twice": _DAILY,
    "append_table": _DAILY,
    "table_like": _REGIONAL,
    "load_problems": """
        SELECT 'FacebookAdLibraryReport_2021-03-01_US_last_7_days_' || c_mktsegment || '.csv' AS member,
               CASE c_custkey % 5 WHEN 0 THEN 'short' WHEN 2 THEN 'quote_stripped' ELSE 'ok' END AS status,
               c_custkey % 5 IN (0, 3) AS amount_invalid, CAST(count(*) AS BIGINT) AS n_records
        FROM customer GROUP BY ALL""",
    "strict_csv": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS page_id, c_name AS page_name,
               CASE WHEN c_custkey % 9 <> 0 THEN {_WHOLE.format('c_acctbal')} END AS amount_spent,
               CASE WHEN c_custkey % 9 <> 0 AND c_custkey % 4 >= 1 THEN 'x1' END AS number_of_ads,
               CASE WHEN c_custkey % 9 = 0 THEN 3 ELSE 4 + c_custkey % 4 END AS n_fields,
               CASE WHEN c_custkey % 9 = 0 THEN 'short' ELSE 'ok' END AS status
        FROM customer""",
    "old_layout": f"""
        SELECT CAST(NULL AS VARCHAR) AS page_id, c_name AS page_name, c_mktsegment || ', Inc' AS disclaimer,
               {_WHOLE.format('c_acctbal')} AS amount_spent, CAST(c_nationkey AS VARCHAR) AS number_of_ads, 'ok' AS status
        FROM customer""",
    "rollup_bad_values": f"""
        WITH r AS ({_EVENT_RECORDS})
        SELECT page_name, 'd' AS disclaimer,
               CAST(SUM(CASE WHEN event_id % 11 IN (0, 1, 2) OR CAST(page_id AS BIGINT) % 7 = 0 THEN 0 ELSE amount END) AS BIGINT) AS amt_spent,
               CAST(SUM(ads) AS BIGINT) AS num_of_ads, page_id, date
        FROM r GROUP BY page_name, page_id, date""",
    "kind_of_file": """
        SELECT event_id, kind, strftime(CAST(ts AS DATE) - (days - 1), '%Y-%m-%d') AS first_day
        FROM events JOIN (VALUES (0, 'daily', 1), (0, 'daily_region', 1), (1, 'weekly_region', 7),
                                 (2, '30days_region', 30), (3, '90days_region', 90), (4, 'lifelong', 0))
                         AS k(m, kind, days) ON event_id % 6 = m""",
    "stream_ingest": _DAILY,
    "stream_redownload": _DAILY,
    "load_emptied": f"SELECT * FROM ({_DAILY}) WHERE date >= '{HALF}'",
    "load_published": f"SELECT * FROM ({_DAILY}) WHERE date >= '{HALF}'",
    "stream_emptied": f"SELECT * FROM ({_DAILY}) WHERE date >= '{HALF}'",
    "load_guards": f"""
        SELECT date, CASE WHEN date < '{HALF}' THEN 'loaded' ELSE 'rejected' END AS state,
               CASE WHEN date < '{HALF}' THEN count(*) END AS n_rows
        FROM ({_DAILY}) GROUP BY date""",
    "append_once": _DAILY,
    "realigned_csv": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS page_id,
               c_name || CASE c_custkey % 6 WHEN 1 THEN ', Inc' WHEN 3 THEN ', Ltd' WHEN 4 THEN ',Co' ELSE '' END AS page_name,
               c_mktsegment || CASE c_custkey % 6 WHEN 2 THEN ', a fund, Inc' WHEN 3 THEN ', PAC' WHEN 4 THEN ', PAC' ELSE '' END AS disclaimer,
               {_WHOLE.format('c_acctbal')} AS amount_spent, CAST(c_nationkey AS VARCHAR) AS number_of_ads,
               CASE c_custkey % 6 WHEN 0 THEN 'ok' WHEN 5 THEN 'long' ELSE 'realigned' END AS status
        FROM customer""",
    "multiline_csv": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS page_id,
               c_name || CASE WHEN c_custkey % 3 = 2 THEN chr(10) || '"and" others,' || chr(10) || 'Inc' ELSE '' END AS page_name,
               CASE WHEN c_custkey % 3 = 1 THEN 'Paid by' || chr(10) ELSE '' END || c_mktsegment AS disclaimer,
               {_WHOLE.format('c_acctbal')} AS amount_spent, CAST(c_nationkey AS VARCHAR) AS number_of_ads, 'ok' AS status
        FROM customer""",
    "censored_bounds": f"""
        WITH r AS ({_EVENT_RECORDS})
        SELECT page_name, disclaimer, page_id, date, CAST(SUM(CASE WHEN amount_text LIKE '≤%' THEN 0 ELSE amount END) AS BIGINT) AS spent_low,
               CAST(SUM(amount) AS BIGINT) AS spent_high, count(*) FILTER (amount_text LIKE '≤%') AS n_censored, count(*) AS n_records
        FROM r GROUP BY page_name, disclaimer, page_id, date""",
    "kept_totals": f"SELECT * FROM ({_TOTALS}) WHERE date >= '{HALF}'",
    # every day between the first and the last report that no report's three days hold, as runs
    "coverage_gaps": """
        WITH r AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS d FROM events WHERE value > 200 AND day(ts) % 7 < 2),
        days AS (SELECT event_type, unnest(generate_series(min(d)::TIMESTAMP, max(d)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d FROM r GROUP BY event_type),
        free AS (SELECT event_type, d FROM days WHERE NOT EXISTS (
                   SELECT 1 FROM r WHERE r.event_type = days.event_type AND days.d BETWEEN r.d - 2 AND r.d)),
        runs AS (SELECT event_type, d, d - CAST(row_number() OVER (PARTITION BY event_type ORDER BY d) AS INTEGER) AS run FROM free)
        SELECT event_type, strftime(min(d), '%Y-%m-%d') AS gap_start, strftime(max(d), '%Y-%m-%d') AS gap_end, count(*) AS gap_days
        FROM runs GROUP BY event_type, run""",
    "period_reconcile": f"""
        WITH r AS ({_EVENT_RECORDS}),
        daily AS (SELECT region, CAST(date AS DATE) AS d, sum(amount) AS spent FROM r
                  WHERE region <> 'R0' OR dayofweek(CAST(date AS DATE)) <> 1 GROUP BY ALL),
        ends AS (SELECT DISTINCT CAST(date AS DATE) AS e FROM r),
        period AS (SELECT region, e, sum(amount) AS spent FROM r JOIN ends ON CAST(date AS DATE) BETWEEN e - 6 AND e
                   WHERE event_id % 997 <> 0 OR region = 'R1' GROUP BY ALL),
        held AS (SELECT p.region, e, p.spent, coalesce(sum(daily.spent), 0) AS own, count(daily.d) AS n
                 FROM period p LEFT JOIN daily ON daily.region = p.region AND daily.d BETWEEN e - 6 AND e GROUP BY ALL)
        SELECT region, strftime(e, '%Y-%m-%d') AS date, CAST(spent AS BIGINT) AS total_spent, CAST(own AS BIGINT) AS daily_spent,
               n AS days_present, CAST(spent - own AS BIGINT) AS difference,
               CASE WHEN n < 7 THEN 'incomplete' WHEN spent <> own THEN 'differs' ELSE 'ok' END AS flag
        FROM held""",
    "robust_spikes": f"""
        WITH r AS ({_EVENT_RECORDS}),
        t AS (SELECT region, date, CAST(sum(amount) AS BIGINT) AS total_spent, CAST(date AS DATE) AS d FROM r GROUP BY region, date),
        p AS (SELECT t.region, t.date, t.total_spent, CAST(count(o.d) AS INTEGER) AS n_history, median(o.total_spent) AS median
              FROM t LEFT JOIN t o ON o.region = t.region AND dayofweek(o.d) = dayofweek(t.d) AND o.d BETWEEN t.d - 28 AND t.d - 1
              GROUP BY ALL),
        m AS (SELECT p.region, p.date, p.total_spent, p.n_history, p.median, median(abs(o.total_spent - p.median)) AS deviation
              FROM p LEFT JOIN t o ON o.region = p.region AND dayofweek(o.d) = dayofweek(CAST(p.date AS DATE))
                   AND o.d BETWEEN CAST(p.date AS DATE) - 28 AND CAST(p.date AS DATE) - 1
              GROUP BY ALL),
        s AS (SELECT *, CASE WHEN n_history >= 2 AND deviation > 0 THEN (total_spent - median) / (1.4826::DOUBLE * deviation) END AS score FROM m)
        SELECT region, date, total_spent, n_history, median, deviation, score,
               CASE WHEN n_history >= 2 AND (CASE WHEN deviation > 0 THEN abs(score) > 3.5 ELSE total_spent <> median END)
                    THEN CASE WHEN total_spent < median THEN 'drop' ELSE 'spike' END ELSE 'ok' END AS flag
        FROM s""",
}


# The operators of the training-data pipeline are an optional part of the package. (An empty
# folder that is left of it has a spec, but no origin.)
_llm = importlib.util.find_spec("adtally.llm")
if _llm is not None and _llm.origin is not None:
    from adtally.llm import queries as llm_queries

    QUERIES.update(llm_queries.QUERIES)
    ORACLES.update(llm_queries.ORACLES)
    if importlib.util.find_spec("corpus_pipeline") is not None:
        import corpus_pipeline

        QUERIES["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL is not None:
            ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the daily advertiser roll-up of report lines built from sf0.001 events."""
    return q_daily_rollup(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL giving the same rows, column names and values as each query."""
    return dict(ORACLES)
