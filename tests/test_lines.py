"""Line repair and tolerant parsing: the line cases of FIXTURES.md §3."""

from pyspark.sql import functions as F

from adtally.operators.lines import drop_header, parse_lines, parse_problems, split_bom
from adtally.operators.rollup import clean_records

B = "﻿"


def lines_frame(spark, lines, member="m.csv"):
    rows = [("a.zip", member, i, line) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "path string, member string, line_no long, line string")


def parsed(spark, lines, layout="new", repair=True, clean=True):
    df = parse_lines(drop_header(split_bom(lines_frame(spark, ["header", *lines]))), layout, repair)
    df = clean_records(df) if clean else df
    return [r.asDict() for r in df.orderBy("line_no", "piece").collect()]


CASES = [
    # line, (page_id, page_name, disclaimer, amount, ads), status
    ("11,Page A,Paid by A,250,3", ("11", "Page A", "Paid by A", 250.0, 3.0), "ok"),
    ('12,Page B,"B, Inc",300,1', ("12", "Page B", "B, Inc", 300.0, 1.0), "ok"),
    ('13,Page C,"Say ""hi"", C",5,1', ("13", "Page C", 'Say "hi", C', 5.0, 1.0), "ok"),
    ('14,Page D,Friends of "Chip” D,≤100,2', ("14", "Page D", "Friends of Chip” D", 100.0, 2.0), "quote_stripped"),
    ('15,Page E,"Open only,100,1', ("15", "Page E", "Open only", 100.0, 1.0), "quote_stripped"),
    ('16,Page F,"Rob "Chip" F, Jr",100,1', ("16", "Page F", 'Rob "Chip" F, Jr', 100.0, 1.0), "ok"),
    (B + "17,Page G,G,10,1", ("17", "Page G", "G", 10.0, 1.0), "ok"),
    ("20,Page J,J", ("20", "Page J", "J", None, None), "short"),
    ("21,Page K,K,5,1,x", ("21", "Page K", "K", 5.0, 1.0), "long"),
    ("22,,L,100,1", ("22", None, "L", 100.0, 1.0), "ok"),
    ("23,NA,M,100,1", ("23", None, "M", 100.0, 1.0), "ok"),
    ("id:24,Page N,N,1,1", ("24", "Page N", "N", 1.0, 1.0), "ok"),
    ("25,P,Q,$250,1", ("25", "P", "Q", 250.0, 1.0), "ok"),
    ("26,P,Q,-5,1", ("26", "P", "Q", 5.0, 1.0), "ok"),
    ('27,P,Q,"1,234",1', ("27", "P", "Q", None, 1.0), "ok"),
    ("28,P,Q,abc,1", ("28", "P", "Q", None, 1.0), "ok"),
    ("29,P,Q,,1", ("29", "P", "Q", None, 1.0), "ok"),
    ("30,P,Q,12d,1", ("30", "P", "Q", None, 1.0), "ok"),
    ("31,P,Q,<= 100,1", ("31", "P", "Q", 100.0, 1.0), "ok"),
    ("32,P,Text more,1,1", ("32", "P", "Text more", 1.0, 1.0), "ok"),
]


def test_line_cases(spark):
    got = parsed(spark, [c[0] for c in CASES])
    assert len(got) == len(CASES)
    for row, (line, want, status) in zip(got, CASES):
        have = (row["page_id"], row["page_name"], row["disclaimer"], row["amount"], row["ads"])
        assert have == want, line
        assert row["status"] == status, line


def test_bom_mid_line_splits_and_blank_lines_vanish(spark):
    got = parsed(spark, ["18,P,H,1,1" + B + "19,P,I,2,1", "", B, "40,P,Z,3,1" + B])
    assert [r["page_id"] for r in got] == ["18", "19", "40"]
    assert [r["piece"] for r in got] == [0, 1, 0]


def test_open_quote_on_last_line_is_repaired(spark):
    got = parsed(spark, ["11,A,B,1,1", '15,Page E,"Open only,100,1'])
    assert got[-1]["disclaimer"] == "Open only" and got[-1]["status"] == "quote_stripped"


def test_header_is_first_record_whatever_it_says(spark):
    df = lines_frame(spark, [B + "11,A,B,1,1" + B + "12,A,B,2,1", "13,A,B,3,1"])
    out = parse_lines(drop_header(split_bom(df)))
    assert sorted(r.page_id for r in out.collect()) == ["12", "13"]


def test_censored_flag(spark):
    got = parsed(spark, ["1,P,Q,≤100,1", "2,P,Q,<= 100,1", "3,P,Q,250,1"])
    assert [r["censored"] for r in got] == [True, True, False]


def test_dirty_page_id_kept_without_cleaning(spark):
    got = parsed(spark, ["id:24,Page N,N,1,1"], clean=False)
    assert got[0]["page_id"] == "id:24"


def test_old_layout_has_no_page_id(spark):
    got = parsed(spark, ["Page A,Paid by A,250,3", "Page B,B,5"], layout="old")
    assert got[0]["page_id"] is None and got[0]["page_name"] == "Page A"
    assert got[0]["amount"] == 250.0 and got[1]["status"] == "short"


def test_regional_layout_accepts_four_to_seven_fields(spark):
    got = parsed(spark, ["1,A,B,10", "2,A,B,20,3", "3,A,B,30,3,x,y", "4,A,B,40,3,x,y,z", "5,A,B"], "regional")
    assert [r["status"] for r in got] == ["ok", "ok", "ok", "long", "short"]
    assert [r["amount"] for r in got] == [10.0, 20.0, 30.0, 40.0, None]


def test_width_repair_when_stripping_fixes_the_count(spark):
    # an even number of quotes that still breaks the field count: the first quoted field
    # runs on to the next closing quote; stripping the quotes gives five fields
    got = parsed(spark, ['7,"P" Q,"R",5,1', '8,P,"A" B","C,5,1'])
    assert got[0]["status"] == "quote_stripped"
    assert (got[0]["page_name"], got[0]["disclaimer"], got[0]["amount"]) == ("P Q", "R", 5.0)
    # here stripping gives six fields, so the line is kept as Spark parsed it
    assert got[1]["status"] == "short"


def test_no_repair_switch_keeps_damaged_line(spark):
    got = parsed(spark, ['15,Page E,"Open only,100,1'], repair=False)
    assert got[0]["status"] == "short"


def test_parse_problems_counts(spark):
    df = parse_lines(drop_header(split_bom(lines_frame(spark, ["h", *[c[0] for c in CASES]]))))
    counts = {
        (r.status, r.amount_invalid): r.n_records for r in parse_problems(df).collect()
    }
    assert counts[("short", True)] == 1
    assert counts[("long", False)] == 1
    assert counts[("quote_stripped", False)] == 2
    assert sum(counts.values()) == len(CASES)
    assert counts[("ok", True)] == 4


def test_empty_text_to_null_both_quoted_and_bare(spark):
    got = parsed(spark, ['1,"",B,1,1', "2,,B,1,1"], clean=False)
    assert got[0]["page_name"] is None and got[1]["page_name"] is None
    assert all(r["status"] == "ok" for r in got)


def test_permuting_lines_changes_nothing(spark):
    body = [c[0] for c in CASES]
    a = parse_lines(drop_header(split_bom(lines_frame(spark, ["h", *body]))))
    b = parse_lines(drop_header(split_bom(lines_frame(spark, ["h", *reversed(body)]))))
    cols = ["page_id", "page_name", "disclaimer", "amount_spent", "number_of_ads", "status"]
    assert sorted(map(tuple, a.select(cols).collect()), key=str) == sorted(
        map(tuple, b.select(cols).collect()), key=str
    )
    assert F  # keep import used


def test_leading_empty_fields_all_count(spark):
    got = parsed(spark, [",,D,5,1", ",,,,", "1,,,,"], clean=False)
    assert [(r["n_fields"], r["status"]) for r in got] == [(5, "ok"), (5, "ok"), (5, "ok")]
    assert (got[0]["page_id"], got[0]["page_name"], got[0]["disclaimer"]) == (None, None, "D")


def test_quoted_line_break_pieces_come_out_short(spark):
    # a quoted field with a real line break arrives as two lines; each has one quote
    got = parsed(spark, ['1,P,"multi', 'line",5,1'], clean=False)
    assert [(r["status"], r["n_fields"]) for r in got] == [("short", 3), ("short", 3)]
    assert got[0]["disclaimer"] == "multi" and got[1]["page_id"] == "line"
