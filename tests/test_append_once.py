"""Appends with tasks that fail, batches that come again, and empty batches."""

import os

import pytest
from pyspark.sql import functions as F

from adtally.sources.append_once import append_once, read_appended


def test_a_failed_and_a_repeated_batch_count_once(spark, tmp_path):
    folder = str(tmp_path / "store")
    rows = spark.range(1000).select("id", F.concat(F.lit("p"), F.col("id")).alias("page")).repartition(4)
    assert read_appended(spark, folder) is None
    # tasks fail once they have handed over all their rows
    def stops_after_writing(batches):
        yield from batches
        raise RuntimeError("lost after writing")

    some = rows.filter("id < 500")
    failing = some.mapInArrow(stops_after_writing, some.schema)
    with pytest.raises(Exception, match="lost after writing"):
        append_once(failing, folder, "2021-01-01/a b")
    assert read_appended(spark, folder) is None
    assert append_once(some, folder, "2021-01-01/a b") and not append_once(some, folder, "2021-01-01/a b")
    assert append_once(rows.filter("id >= 500"), folder, "second")
    assert append_once(rows.limit(0), folder, "none") and not append_once(rows, folder, "none")
    got = read_appended(spark, folder)
    assert got.dtypes == rows.dtypes and sorted(r.id for r in got.collect()) == list(range(1000))


def test_of_two_writers_of_one_batch_the_first_note_counts(spark, tmp_path, monkeypatch):
    from adtally.sources import append_once as module

    folder, df = str(tmp_path / "store"), spark.range(10)
    names_in = module.names_in
    assert append_once(df, folder, "b")
    # the second one looked before the first had made its note
    monkeypatch.setattr(module, "names_in", lambda s, f: {})
    assert not append_once(df, folder, "b")
    monkeypatch.setattr(module, "names_in", names_in)
    assert read_appended(spark, folder).count() == 10
    assert len([n for n in os.listdir(f"{folder}/notes") if n[0] not in "._"]) == 1
