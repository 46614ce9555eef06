
import csv
import io
import random

from adtally.operators.lines import BOM, drop_header, parse_lines, split_bom
from adtally.operators.rollup import clean_records, national_rollup

ALPHABET = 'ab Z9,"’”;:é-_$≤<.' + " "


def random_field(rng):
    n = rng.randint(0, 12)
    text = "".join(rng.choice(ALPHABET) for _ in range(n))
    return "x" + text if text == "NA" else text


def to_line(fields):
    buf = io.StringIO()
    csv.writer(buf, lineterminator="").writerow(fields)
    return buf.getvalue()


def frame(spark, lines):
    rows = [("a.zip", "m.csv", i, line) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "path string, member string, line_no long, line string")


def test_valid_csv_round_trips(spark):
    rng = random.Random(7)
    records = [[random_field(rng) for _ in range(5)] for _ in range(600)]
    lines = ["h"] + [to_line(r) for r in records]
    got = parse_lines(drop_header(split_bom(frame(spark, lines))), "new")
    cols = ["page_id", "page_name", "disclaimer", "amount_spent", "number_of_ads"]
    have = {r.line_no: (tuple(r[c] for c in cols), r.status) for r in got.collect()}
    for i, rec in enumerate(records, start=1):
        want = tuple(v if v != "" else None for v in rec)
        assert have[i] == (want, "ok"), (lines[i], have[i])


def test_bom_at_line_starts_changes_nothing(spark):
    rng = random.Random(11)
    body = [f"{rng.randint(1, 30)},P{rng.randint(1, 4)},D,{rng.randint(0, 500)},{rng.randint(0, 3)}" for _ in range(300)]
    plain = ["h", *body]
    marked = ["h", *[(BOM + line) if i % 3 == 0 else line for i, line in enumerate(body)]]

    def rollup(lines):
        df = frame(spark, lines).withColumn("date", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("2021-03-01"))
        out = national_rollup(clean_records(parse_lines(drop_header(split_bom(df)), "new")))
        return sorted(tuple(r) for r in out.collect())

    assert rollup(plain) == rollup(marked)
