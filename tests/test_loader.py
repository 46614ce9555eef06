"""Batch loads over ZIP fixtures: the loading cases of FIXTURES.md §4."""

import datetime
import os

import pytest

from adtally.plans.kinds import KINDS
from adtally.plans.loader import RejectedArchives, run_batch
from adtally.sources.archive import choose_new, list_archives
from zipfixtures import (
    HEADER_NEW,
    HEADER_REGION,
    archive_name,
    csv_text,
    national_member,
    region_member,
    write_zip,
)

DAILY_ROWS = [
    "11,Page A,Paid by A,250,3",
    '12,Page B,"B, Inc",300,1',
    "11,Page A,Paid by A,≤100,2",
    "13,Renamed,X,50,",
    "13,Original,X,5,",
    '14,Page D,Friends of "Chip” D,≤100,2',
]


def daily_archive(folder, date, rows=DAILY_ROWS, mtime=None, regions=None, suffix=""):
    members = {national_member("yesterday", date): csv_text(HEADER_NEW, rows)}
    for region, rrows in (regions or {}).items():
        members[region_member("yesterday", date, region)] = csv_text(HEADER_REGION, rrows)
    members["regions/readme.txt"] = "not a report"
    return write_zip(os.path.join(folder, archive_name("yesterday", date, suffix)), members, mtime)


def table_rows(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def test_daily_end_to_end(spark, fresh_db, tmp_path):
    src = str(tmp_path / "Daily")
    daily_archive(src, "2021-03-01")
    t = f"{fresh_db}.fb_daily"
    assert run_batch(spark, "daily", src, target=t) == ["2021-03-01"]
    got = {(r.page_name, r.page_id): r for r in spark.table(t).collect()}
    assert got[("Page A", "11")].amt_spent == 350 and got[("Page A", "11")].num_of_ads == 5
    assert got[("Page B", "12")].disclaimer == "B, Inc"
    assert got[("Renamed", "13")].num_of_ads == 0  # all ads missing: 0, not null
    assert got[("Original", "13")].amt_spent == 5
    assert got[("Page D", "14")].disclaimer == "Friends of Chip” D"
    assert {r.date for r in got.values()} == {"2021-03-01"}
    assert spark.table(t).columns == [
        "page_name", "disclaimer", "amt_spent", "num_of_ads", "page_id", "date",
    ]


def test_second_run_changes_nothing_and_loaded_is_skipped(spark, fresh_db, tmp_path):
    src = str(tmp_path / "Daily")
    daily_archive(src, "2021-03-01")
    t = f"{fresh_db}.fb_daily"
    run_batch(spark, "daily", src, target=t)
    before = table_rows(spark, t)
    # the loaded archive is now unreadable, though not newer: if it were opened, it would be rejected
    path = os.path.join(src, archive_name("yesterday", "2021-03-01"))
    times = os.stat(path)
    with open(path, "wb") as f:
        f.write(b"not a zip")
    os.utime(path, ns=(times.st_atime_ns, times.st_mtime_ns))
    assert run_batch(spark, "daily", src, target=t) == []
    assert table_rows(spark, t) == before


def test_floor_dates(spark, fresh_db, tmp_path):
    src = str(tmp_path / "Daily")
    daily_archive(src, "2021-01-05")
    daily_archive(src, "2021-01-06")
    assert run_batch(spark, "daily", src, target=f"{fresh_db}.d") == ["2021-01-06"]
    # the 90-day kind starts earlier
    src90 = str(tmp_path / "90Days")
    date = "2021-01-05"
    write_zip(
        os.path.join(src90, archive_name("last_90_days", date)),
        {region_member("last_90_days", date, "Ohio"): csv_text(HEADER_REGION, ["1,A,B,10"])},
    )
    assert run_batch(spark, "90days_region", src90, target=f"{fresh_db}.r") == [date]
    assert KINDS["90days_region"].floor_date == "2020-02-09"


def test_two_archives_one_date_latest_wins(spark, fresh_db, tmp_path):
    src = str(tmp_path / "Daily")
    old = daily_archive(os.path.join(src, "a"), "2021-03-01", rows=["1,Old,X,1,1"], mtime=1_000_000)
    new = daily_archive(os.path.join(src, "b"), "2021-03-01", rows=["1,New,X,2,1"], mtime=2_000_000)
    assert old != new
    t = f"{fresh_db}.fb_daily"
    files = list_archives(spark, src + "/*", "daily")
    assert files.count() == 2
    chosen = choose_new(files, None, None).collect()
    assert len(chosen) == 1 and chosen[0].path.endswith("b/" + os.path.basename(new))
    run_batch(spark, "daily", src + "/*", target=t)
    assert [r.page_name for r in spark.table(t).collect()] == ["New"]


def test_name_with_space_is_not_matched(spark, tmp_path):
    src = str(tmp_path / "Daily")
    daily_archive(src, "2021-03-01", suffix=" (1)")
    assert list_archives(spark, src, "daily").count() == 0


def test_date_mismatch_fails_by_default(spark, fresh_db, tmp_path):
    src = str(tmp_path / "Daily")
    members = {national_member("yesterday", "2021-03-02"): csv_text(HEADER_NEW, ["1,A,B,1,1"])}
    write_zip(os.path.join(src, archive_name("yesterday", "2021-03-01")), members)
    with pytest.raises(Exception, match="differs from its archive"):
        run_batch(spark, "daily", src, target=f"{fresh_db}.a")
    got = run_batch(spark, "daily", src, target=f"{fresh_db}.b", on_date_mismatch="use_archive_date")
    assert got == ["2021-03-01"]
    assert [r.date for r in spark.table(f"{fresh_db}.b").collect()] == ["2021-03-01"]


def test_empty_archive_names_the_archive(spark, fresh_db, tmp_path):
    src = str(tmp_path / "Lifelong")
    write_zip(os.path.join(src, archive_name("lifelong", "2021-03-01")), {"readme.txt": "x"})
    with pytest.raises(RejectedArchives, match="FacebookAdLibraryReport_2021-03-01_US_lifelong.zip"):
        run_batch(spark, "lifelong", src, target=f"{fresh_db}.l")


def test_regional_mixed_widths(spark, fresh_db, tmp_path):
    src = str(tmp_path / "Weekly")
    date = "2021-03-07"
    members = {
        region_member("last_7_days", date, "Ohio"): csv_text(HEADER_REGION, ["1,A,B,10", "1,A,B,≤100"]),
        region_member("last_7_days", date, "New York"): csv_text(
            HEADER_NEW, ["1,A,B,7,3", '2,C,"Open,5,1']
        ),
        "regions/readme.txt": "ignore me",
    }
    write_zip(os.path.join(src, archive_name("last_7_days", date)), members)
    t = f"{fresh_db}.fb_weekly_region"
    assert run_batch(spark, "weekly_region", src, target=t) == [date]
    got = {(r.region, r.page_id): (r.amt_spent, r.disclaimer) for r in spark.table(t).collect()}
    assert got == {
        ("Ohio", "1"): (110, "B"),
        ("New York", "1"): (7, "B"),
        ("New York", "2"): (5, "Open"),
    }
    assert spark.table(t).columns == [
        "page_name", "disclaimer", "amt_spent", "region", "page_id", "date",
    ]


def test_lifelong_first_member_two_sinks_and_dirty_ids(spark, fresh_db, tmp_path):
    src = str(tmp_path / "Lifelong")
    date = "2021-03-01"
    members = {
        national_member("lifelong", date, revamp=False): csv_text(HEADER_NEW, ["99,Z,Z,1,1"]),
        national_member("lifelong", date, revamp=True): csv_text(HEADER_NEW, ["id:24,A,B,10,1"]),
    }
    write_zip(os.path.join(src, archive_name("lifelong", date)), members)
    first, second = f"{fresh_db}.fb_lifelong", f"{fresh_db}.warehouse_lifelong"
    assert run_batch(spark, "lifelong", src, target=first, second_target=second) == [date]
    # first member in code-point order only ("ReportRevamp_" sorts before "Report_")
    want = [("A", "B", 10, 1, "id:24", date)]
    assert table_rows(spark, first) == want
    assert table_rows(spark, second) == want


def test_half_written_two_sinks_complete_on_next_run(spark, fresh_db, tmp_path):
    from adtally.sources.tables import create_target, overwrite_dates

    src = str(tmp_path / "Lifelong")
    date = "2021-03-01"
    members = {national_member("lifelong", date): csv_text(HEADER_NEW, ["1,A,B,10,1"])}
    write_zip(os.path.join(src, archive_name("lifelong", date)), members)
    first, second = f"{fresh_db}.one", f"{fresh_db}.two"
    create_target(spark, first)
    create_target(spark, second)
    # a crash after the first sink: only `first` has the date
    row = spark.createDataFrame(
        [("A", "B", 10, 1, "1", date)],
        "page_name string, disclaimer string, amt_spent long, num_of_ads long, page_id string, date string",
    )
    overwrite_dates(row, first)
    assert run_batch(spark, "lifelong", src, target=first, second_target=second) == [date]
    assert table_rows(spark, first) == table_rows(spark, second) == [("A", "B", 10, 1, "1", date)]


def test_one_daily_archive_feeds_national_and_regional(spark, fresh_db, tmp_path):
    src = str(tmp_path / "Daily")
    daily_archive(src, "2021-03-01", regions={"Ohio": ["11,Page A,Paid by A,≤100"]})
    run_batch(spark, "daily", src, target=f"{fresh_db}.n")
    run_batch(spark, "daily_region", src, target=f"{fresh_db}.r")
    assert spark.table(f"{fresh_db}.n").count() == 5
    assert [tuple(r) for r in spark.table(f"{fresh_db}.r").collect()] == [
        ("Page A", "Paid by A", 100, "Ohio", "11", "2021-03-01")
    ]


def test_shared_daily_archive_read_once_for_two_kinds(spark, fresh_db, tmp_path):
    from adtally.plans.loader import run_shared_archives

    src = str(tmp_path / "Daily")
    daily_archive(src, "2021-03-01", regions={"Ohio": ["11,Page A,Paid by A,≤100"]})
    daily_archive(src, "2021-03-02", regions={"Utah": ["12,Page B,B,5"]})
    n, r = f"{fresh_db}.n", f"{fresh_db}.r"
    got = run_shared_archives(spark, src, {"daily": n, "daily_region": r})
    assert got == {"daily": ["2021-03-01", "2021-03-02"], "daily_region": ["2021-03-01", "2021-03-02"]}
    assert spark.table(n).count() == 10
    assert sorted((x.region, x.amt_spent) for x in spark.table(r).collect()) == [("Ohio", 100), ("Utah", 5)]
    # a second run finds nothing new
    assert run_shared_archives(spark, src, {"daily": n, "daily_region": r}) == {}


def test_loaded_dates_from_another_source(spark, fresh_db, tmp_path):
    src = str(tmp_path / "Daily")
    daily_archive(src, "2021-03-01")
    daily_archive(src, "2021-03-02")
    loaded = spark.createDataFrame([("2021-03-01",)], "date string")
    assert run_batch(spark, "daily", src, target=f"{fresh_db}.d", loaded=loaded) == ["2021-03-02"]


@pytest.mark.parametrize("reader", ["archive", "members"])
def test_both_readers_give_the_same_table(spark, fresh_db, tmp_path, reader):
    src = str(tmp_path / "Weekly")
    date = "2021-03-07"
    members = {
        region_member("last_7_days", date, r): csv_text(HEADER_REGION, [f"{i},A,B,{10 * i}", '9,C,"Open,5'])
        for i, r in enumerate(["Ohio", "Utah", "New York"], start=1)
    }
    members["regions/readme.txt"] = "ignore me"
    write_zip(os.path.join(src, archive_name("last_7_days", date)), members)
    t = f"{fresh_db}.w_{reader}"
    assert run_batch(spark, "weekly_region", src, target=t, reader=reader) == [date]
    got = sorted(tuple(r) for r in spark.table(t).collect())
    assert got == sorted(
        [("A", "B", 10 * i, r, str(i), date) for i, r in enumerate(["Ohio", "Utah", "New York"], 1)]
        + [("C", "Open", 5, r, "9", date) for r in ["Ohio", "Utah", "New York"]]
    )


def test_member_reader_partitions_and_errors(spark, tmp_path):
    from adtally.sources.zip_members import read_members

    src = str(tmp_path / "z")
    a = write_zip(os.path.join(src, "a.zip"), {"x1.csv": "h\n1\n2\n", "x2.csv": "h\n3\n", "y.txt": "no"})
    lines = read_members(spark, [a], r"\.csv$", partitions=3)
    assert lines.rdd.getNumPartitions() == 3
    assert sorted((r.member, r.line_no, r.line) for r in lines.collect()) == [
        ("x1.csv", 0, "h"), ("x1.csv", 1, "1"), ("x1.csv", 2, "2"), ("x2.csv", 0, "h"), ("x2.csv", 1, "3"),
    ]
    first = read_members(spark, [a], r"\.csv$", first_member_only=True)
    assert {r.member for r in first.collect()} == {"x1.csv"}
    b = write_zip(os.path.join(src, "b.zip"), {"y.txt": "no"})
    c = os.path.join(src, "c.zip")
    with open(c, "wb") as f:
        f.write(b"damaged")
    got = {r.path: (r.line_no, r.line) for r in read_members(spark, [b, c], r"\.csv$").collect()}
    assert got[b][0] == got[c][0] == -1
    assert "no report CSV" in got[b][1] and "b.zip" in got[b][1] and got[c][1]


def test_second_sink_in_another_format(spark, fresh_db, tmp_path):
    from adtally.sources.tables import PathSink

    src = str(tmp_path / "Lifelong")
    date = "2021-03-01"
    members = {national_member("lifelong", date): csv_text(HEADER_NEW, ["1,A,B,10,1", "2,C,D,≤100,3"])}
    write_zip(os.path.join(src, archive_name("lifelong", date)), members)
    sink = PathSink(str(tmp_path / "warehouse_lifelong"), format="json")
    first = f"{fresh_db}.fb_lifelong"
    assert run_batch(spark, "lifelong", src, target=first, second_target=sink) == [date]
    back = spark.read.json(sink.path)
    got = sorted((r.page_name, r.amt_spent, r.num_of_ads, str(r.date)) for r in back.collect())
    assert got == [("A", 10, 1, date), ("C", 100, 3, date)]
    # both sinks have the date: a second run loads nothing
    assert run_batch(spark, "lifelong", src, target=first, second_target=sink) == []


@pytest.mark.parametrize(
    "kind,label",
    [("daily_region", "yesterday"), ("weekly_region", "last_7_days"),
     ("30days_region", "last_30_days"), ("90days_region", "last_90_days")],
)
def test_every_regional_kind(spark, fresh_db, tmp_path, kind, label):
    src = str(tmp_path / kind)
    date = "2022-05-31"
    members = {
        region_member(label, date, "Ohio"): csv_text(HEADER_REGION, ["1,A,B,10", "1,A,B,5"]),
        region_member(label, date, "District of Columbia"): csv_text(HEADER_REGION, ["2,C,D,≤100"]),
    }
    if kind == "daily_region":
        members[national_member(label, date)] = csv_text(HEADER_NEW, ["9,Z,Z,1,1"])
    write_zip(os.path.join(src, archive_name(label, date)), members)
    t = f"{fresh_db}.{kind}"
    assert run_batch(spark, kind, src, target=t) == [date]
    got = sorted((r.region, r.page_id, r.amt_spent) for r in spark.table(t).collect())
    assert got == [("District of Columbia", "2", 100), ("Ohio", "1", 15)]


def test_reader_line_ends_and_unicode_separators(spark, fresh_db, tmp_path):
    src = str(tmp_path / "Daily")
    date = "2021-03-01"
    text = (HEADER_NEW + "\r\n" + "1,A,Fund\u2028Two,10,1\r\n" + "2,B,X\u0085Y,5,1\r" + "3,C,D,1,1\n").encode("utf-8")
    write_zip(os.path.join(src, archive_name("yesterday", date)), {national_member("yesterday", date): text})
    t = f"{fresh_db}.d"
    run_batch(spark, "daily", src, target=t)
    got = sorted((r.page_id, r.disclaimer, r.amt_spent) for r in spark.table(t).collect())
    assert got == [("1", "Fund\u2028Two", 10), ("2", "X\u0085Y", 5), ("3", "D", 1)]


@pytest.mark.parametrize("reader", ["archive", "members"])
def test_bad_archives_are_named_and_the_good_one_is_stored(spark, fresh_db, tmp_path, reader):
    src = str(tmp_path / "Daily")
    daily_archive(src, "2021-03-01")
    for date, content in (("2021-03-02", b"damaged"), ("2021-03-03", b"PK\5\6" + bytes(18))):
        with open(os.path.join(src, archive_name("yesterday", date)), "wb") as f:
            f.write(content)
    write_zip(os.path.join(src, archive_name("yesterday", "2021-03-04")), {"readme.txt": "x"})
    other = {national_member("yesterday", "2021-03-09"): csv_text(HEADER_NEW, ["1,A,B,1,1"])}
    write_zip(os.path.join(src, archive_name("yesterday", "2021-03-05")), other)
    write_zip(os.path.join(src, archive_name("yesterday", "undated")), {"readme.txt": "x"})
    # a member whose compressed bytes are damaged in the middle
    path = daily_archive(src, "2021-03-06", rows=[f"{i},Page {i},D,{i},1" for i in range(5000)])
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2 : len(data) // 2 + 40] = b"x" * 40
    open(path, "wb").write(data)
    t = f"{fresh_db}.d"
    got = run_batch(spark, "daily", src, target=t, reader=reader, on_reject="return")
    assert got == ["2021-03-01"]
    reasons = {os.path.basename(p).split("_")[1]: r for p, r in got.rejected}
    assert set(reasons) == {"2021-03-02", "2021-03-03", "2021-03-04", "2021-03-05", "2021-03-06", "undated"}
    assert "no report CSV" in reasons["2021-03-04"] and "differs from its archive" in reasons["2021-03-05"]
    assert {r.date for r in spark.table(t).collect()} == {"2021-03-01"}
    with pytest.raises(RejectedArchives, match="undated") as e:
        run_batch(spark, "daily", src, target=t, reader=reader)
    assert e.value.loaded == []


@pytest.mark.parametrize("reader", ["archive", "members"])
@pytest.mark.parametrize("folder", ["sp ace", "gl[1]", "br{a}ce", "Exchange"])
def test_odd_folder_names(spark, fresh_db, tmp_path, reader, folder):
    src = str(tmp_path / folder)
    daily_archive(src, "2021-03-01", suffix="")
    prefixed = {national_member("yesterday", "2021-03-02"): csv_text(HEADER_NEW, ["1,A,B,1,1"])}
    write_zip(os.path.join(src, "copy {a} " + archive_name("yesterday", "2021-03-02")), prefixed)
    got = run_batch(spark, "daily", src, target=f"{fresh_db}.d", reader=reader)
    assert got == ["2021-03-01", "2021-03-02"]
    assert spark.table(f"{fresh_db}.d").count() == 6


def test_a_newer_copy_replaces_its_date(spark, fresh_db, tmp_path):
    src, t = str(tmp_path / "Daily"), f"{fresh_db}.d"
    daily_archive(os.path.join(src, "a"), "2021-03-01", rows=["1,Old,X,10,1"], mtime=1_000_000)
    assert run_batch(spark, "daily", src + "/*", target=t) == ["2021-03-01"]
    daily_archive(os.path.join(src, "b"), "2021-03-01", rows=["1,New,X,99,1"], mtime=2_000_000)
    assert run_batch(spark, "daily", src + "/*", target=t) == ["2021-03-01"]
    assert [(r.page_name, r.amt_spent) for r in spark.table(t).collect()] == [("New", 99)]
    daily_archive(os.path.join(src, "c"), "2021-03-01", rows=["1,Older,X,1,1"], mtime=1_500_000)
    assert run_batch(spark, "daily", src + "/*", target=t) == []


def test_an_unfinished_load_is_done_again(spark, fresh_db, tmp_path):
    from adtally.sources.tables import create_target, overwrite_dates, record_loads

    src, t = str(tmp_path / "Daily"), f"{fresh_db}.d"
    path = daily_archive(src, "2021-03-01", mtime=2_000_000)
    # a new date was noted, then the load broke off before its rows were written
    create_target(spark, t)
    record_loads(spark, t, [(path, datetime.datetime(2021, 3, 1), "2021-03-01")])
    assert run_batch(spark, "daily", src, target=t) == ["2021-03-01"]
    assert run_batch(spark, "daily", src, target=t) == []
    # a date was replaced from a newer archive, then the load broke off before it was noted
    daily_archive(src, "2021-03-01", rows=["1,New,X,2,1"], mtime=datetime.datetime(2021, 4, 1).timestamp())
    row = spark.table(t).limit(1)
    overwrite_dates(row, t)
    assert run_batch(spark, "daily", src, target=t) == ["2021-03-01"]
    assert [r.page_name for r in spark.table(t).collect()] == ["New"]
    assert run_batch(spark, "daily", src, target=t) == []


def test_problems_and_malformed_records(spark, fresh_db, tmp_path):
    from adtally.sources.tables import PathSink

    src = str(tmp_path / "Daily")
    rows = ["1,A,B,10,1", "2,C,D", "3,E,F,5,1,x,y", '4,G,"Open,7,1', "5,H,I,abc,1", "6,J,K," + "9" * 23 + ",1"]
    rows.append("7,L,M," + ",".join("1" for _ in range(25_000)))
    daily_archive(src, "2021-03-01", rows=rows)
    problems = PathSink(str(tmp_path / "problems"))
    keep, drop = f"{fresh_db}.keep", f"{fresh_db}.drop"
    run_batch(spark, "daily", src, target=keep, problems=problems)
    run_batch(spark, "daily", src, target=drop, on_malformed="drop")
    assert {r.page_id: r.amt_spent for r in spark.table(keep).collect()} == {"1": 10, "2": 0, "3": 5, "4": 7, "5": 0, "6": 0, "7": 1}
    assert {r.page_id for r in spark.table(drop).collect()} == {"1", "4", "5", "6"}
    found = {(r.status, r.amount_invalid): r.n_records for r in spark.read.parquet(problems.path).collect()}
    assert found == {("ok", False): 1, ("ok", True): 2, ("short", True): 1, ("long", False): 2, ("quote_stripped", False): 1}


def test_sinks_that_cannot_replace_a_date_are_refused(spark, tmp_path):
    from adtally.sources.tables import PathSink, read_sink

    with pytest.raises(ValueError, match="format"):
        PathSink(str(tmp_path / "x"), format="bigquery")
    assert read_sink(spark, PathSink(str(tmp_path / "none"))) is None
    bad = tmp_path / "bad" / "date=2021-03-01"
    bad.mkdir(parents=True)
    (bad / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_sink(spark, PathSink(str(tmp_path / "bad"))).collect()


@pytest.mark.parametrize("reader", ["archive", "members"])
def test_shared_archives_with_either_reader_and_a_missing_kind(spark, fresh_db, tmp_path, reader):
    from adtally.plans.loader import run_shared_archives

    src = str(tmp_path / "Daily")
    daily_archive(src, "2021-03-01", regions={"Ohio": ["11,Page A,Paid by A,7"]})
    daily_archive(src, "2021-03-02")  # no regional member
    n, r = f"{fresh_db}.n", f"{fresh_db}.r"
    got = run_shared_archives(spark, src, {"daily": n, "daily_region": r}, reader=reader, on_reject="return")
    assert got == {"daily": ["2021-03-01", "2021-03-02"], "daily_region": ["2021-03-01"]}
    assert [os.path.basename(p) for p, _ in got["daily_region"].rejected] == [archive_name("yesterday", "2021-03-02")]
    assert "daily_region" in got["daily_region"].rejected[0][1] and got["daily"].rejected == []
