"""The command line runs the same loads."""

import json
import os
import subprocess
import sys

from adtally.__main__ import main
from zipfixtures import HEADER_NEW, archive_name, csv_text, national_member, write_zip


def test_cli_load_ingest_and_totals(spark, fresh_db, tmp_path):
    src = str(tmp_path / "Daily")
    for day, amount in (("01", 100), ("02", 100), ("03", 400)):
        date = f"2021-03-{day}"
        members = {national_member("yesterday", date): csv_text(HEADER_NEW, [f"1,A,B,{amount},1"])}
        write_zip(os.path.join(src, archive_name("yesterday", date)), members)
    t = f"{fresh_db}.fb_daily"
    got = main(["load", "--kind", "daily", "--source", src, "--target", t], spark=spark)
    assert got["loaded_dates"] == ["2021-03-01", "2021-03-02", "2021-03-03"]
    again = main(
        ["ingest", "--kind", "daily", "--source", src, "--checkpoint", str(tmp_path / "ck"), "--target", t],
        spark=spark,
    )
    assert again["kind"] == "daily"
    assert spark.table(t).count() == 3
    flags = main(["totals", "--table", t, "--threshold", "0.5"], spark=spark)
    assert flags["flagged"] == [("2021-03-03", "spike")]


def test_cli_shared_reads_daily_archives_once_for_both_tables(spark, fresh_db, tmp_path):
    from zipfixtures import HEADER_REGION, region_member

    src = str(tmp_path / "Daily")
    date = "2021-03-05"
    members = {
        national_member("yesterday", date): csv_text(HEADER_NEW, ["1,A,B,10,1"]),
        region_member("yesterday", date, "Ohio"): csv_text(HEADER_REGION, ["1,A,B,4"]),
    }
    write_zip(os.path.join(src, archive_name("yesterday", date)), members)
    n, r = f"{fresh_db}.n", f"{fresh_db}.r"
    got = main(["shared", "--source", src, "--targets", f"daily={n},daily_region={r}"], spark=spark)
    assert got["loaded_dates"] == {"daily": [date], "daily_region": [date]}
    assert [tuple(x) for x in spark.table(r).collect()] == [("A", "B", 4, "Ohio", "1", date)]


def cli(tmp_path, *args):
    """The command line in a process of its own, with a warehouse folder but no lasting catalog."""
    env = os.environ | {
        "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
        "PYSPARK_SUBMIT_ARGS": f"--master local[2] --conf spark.ui.enabled=false --conf spark.sql.warehouse.dir={tmp_path}/warehouse pyspark-shell",
    }
    done = subprocess.run([sys.executable, "-m", "adtally", *args], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    return done.returncode, json.loads(done.stdout.strip().splitlines()[-1]) if done.stdout.strip() else done.stderr[-2000:]


def test_scheduled_runs_in_two_processes(tmp_path):
    src = str(tmp_path / "Daily")

    def add(date):
        members = {national_member("yesterday", date): csv_text(HEADER_NEW, ["1,A,B,10,1"])}
        write_zip(os.path.join(src, archive_name("yesterday", date)), members)

    add("2021-03-01")
    assert cli(tmp_path, "load", "--kind", "daily", "--source", src) == (0, {"kind": "daily", "loaded_dates": ["2021-03-01"], "rejected": []})
    assert cli(tmp_path, "load", "--kind", "daily", "--source", src) == (0, {"kind": "daily", "loaded_dates": [], "rejected": []})
    add("2021-03-02")
    with open(os.path.join(src, archive_name("yesterday", "2021-03-03")), "wb") as f:
        f.write(b"damaged")
    status, out = cli(tmp_path, "load", "--kind", "daily", "--source", src)
    assert status == 1 and out["loaded_dates"] == ["2021-03-02"] and len(out["rejected"]) == 1
    assert cli(tmp_path, "totals", "--table", "fb_daily") == (0, {"flagged": []})
