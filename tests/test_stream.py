"""Incremental ingest with Structured Streaming (availableNow)."""

import os

from adtally.plans.loader import run_batch
from adtally.streaming.ingest import start_ingest
from zipfixtures import HEADER_NEW, archive_name, csv_text, national_member, write_zip


def add_daily(folder, date, rows):
    members = {national_member("yesterday", date): csv_text(HEADER_NEW, rows)}
    return write_zip(os.path.join(folder, archive_name("yesterday", date)), members)


def drain(spark, src, ckpt, table):
    q = start_ingest(spark, "daily", src, ckpt, target=table)
    q.awaitTermination()
    assert q.exception() is None


def rows(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def test_drain_add_drain_equals_batch(spark, fresh_db, tmp_path):
    src, ckpt = str(tmp_path / "Daily"), str(tmp_path / "ckpt")
    t = f"{fresh_db}.stream"
    add_daily(src, "2021-03-01", ["1,A,B,10,1", "1,A,B,5,2"])
    drain(spark, src, ckpt, t)
    assert rows(spark, t) == [("A", "B", 15, 3, "1", "2021-03-01")]
    add_daily(src, "2021-03-02", ["2,C,D,≤100,1"])
    drain(spark, src, ckpt, t)
    # a batch run over the same folder gives the same table
    b = f"{fresh_db}.batch"
    run_batch(spark, "daily", src, target=b)
    assert rows(spark, t) == rows(spark, b) == [
        ("A", "B", 15, 3, "1", "2021-03-01"),
        ("C", "D", 100, 1, "2", "2021-03-02"),
    ]


def test_no_new_file_no_change_and_lost_checkpoint_is_harmless(spark, fresh_db, tmp_path):
    src = str(tmp_path / "Daily")
    t = f"{fresh_db}.stream"
    add_daily(src, "2021-03-01", ["1,A,B,10,1"])
    drain(spark, src, str(tmp_path / "ckpt1"), t)
    before = rows(spark, t)
    drain(spark, src, str(tmp_path / "ckpt1"), t)
    assert rows(spark, t) == before
    # a fresh checkpoint replays the folder; the date is already loaded: still one copy
    drain(spark, src, str(tmp_path / "ckpt2"), t)
    assert rows(spark, t) == before


def test_bounded_micro_batches(spark, fresh_db, tmp_path):
    src, ckpt = str(tmp_path / "Daily"), str(tmp_path / "ckpt")
    for day in ("01", "02", "03"):
        add_daily(src, f"2021-03-{day}", [f"{day},A,B,1,1"])
    t = f"{fresh_db}.stream"
    q = start_ingest(spark, "daily", src, ckpt, target=t, max_files_per_trigger=1)
    q.awaitTermination()
    assert len(q.recentProgress) >= 3
    assert sorted(r.date for r in spark.table(t).collect()) == ["2021-03-01", "2021-03-02", "2021-03-03"]
