"""Records over several lines, against Python's csv module."""

import csv
import io
import random

import pytest

from adtally.operators.lines import parse_lines
from adtally.operators.records import join_records
from adtally.plans.loader import run_batch
from test_loader import daily_archive

SCHEMA = "path string, member string, line_no long, line string, extra int"


def physical(text):
    return text.split("\n")


@pytest.mark.parametrize("slice_lines", [1, 3, 10_000])
def test_against_the_csv_module(spark, slice_lines):
    rng = random.Random(5)
    bits = ["a", "b, c", 'say "x"', "one\ntwo", "\n", '"', "three\n\nfour", "", "end"]
    rows, want = [], {}
    for member in ("m1", "m2", "m3"):
        records = [["k" + str(i), *["".join(rng.choices(bits, k=rng.randrange(3))) for _ in range(3)]] for i in range(60)]
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows(records)
        text = out.getvalue().rstrip("\n")
        rows += [("a.zip", member, i, x, 7) for i, x in enumerate(physical(text))]
        want[member] = records
    rng.shuffle(rows)
    got = join_records(spark.createDataFrame(rows, SCHEMA), slice_lines=slice_lines)
    assert got.columns == ["path", "member", "line_no", "line", "extra"]
    found = got.collect()
    for member, records in want.items():
        mine = sorted((r.line_no, r.line) for r in found if r.member == member)
        assert [next(csv.reader(io.StringIO(line))) if "\n" not in line else list(csv.reader(io.StringIO(line)))[0] for _, line in mine] == records
    assert {r.extra for r in found} == {7}


def test_a_quote_left_open_does_not_collect_the_rest(spark):
    lines = ['h,"open'] + [f"{i},b,c" for i in range(50)]
    rows = [("a.zip", "m", i, x, 1) for i, x in enumerate(lines)] + [("b.zip", None, -1, 'no "archive', 1)]
    got = sorted((r.path, r.line_no, r.line) for r in join_records(spark.createDataFrame(rows, SCHEMA), 7, max_lines=20).collect())
    assert got == sorted((p, n, x) for p, _, n, x, _ in rows)
    whole = join_records(spark.createDataFrame(rows, SCHEMA), 7, max_lines=100).filter("path = 'a.zip'").collect()
    assert len(whole) == 1 and whole[0].line == "\n".join(lines)


def test_fields_with_breaks_are_parsed_and_loaded(spark, fresh_db, tmp_path):
    rows = ['1,"Page\nof two lines","Payer, Inc",10,2', "2,Other,Payer,5,1", '3,Third,"a\n\nb",7,1']
    df = spark.createDataFrame([("a", "m", i, x, 0) for i, x in enumerate(physical("\n".join(rows)))], SCHEMA)
    parsed = {r.page_id: (r.page_name, r.disclaimer, r.amount_spent, r.status) for r in parse_lines(join_records(df), repair_quotes=False).collect()}
    assert parsed["1"] == ("Page\nof two lines", "Payer, Inc", "10", "ok") and parsed["3"] == ("Third", "a\n\nb", "7", "ok")
    daily_archive(str(tmp_path / "d"), "2021-03-01", rows)
    run_batch(spark, "daily", str(tmp_path / "d"), target=f"{fresh_db}.t", multiline=True, repair_quotes=False)
    got = {r.page_id: (r.page_name, r.amt_spent) for r in spark.table(f"{fresh_db}.t").collect()}
    assert got == {"1": ("Page\nof two lines", 10), "2": ("Other", 5), "3": ("Third", 7)}
