"""The corpus pipeline, stage by stage, on the smallest table."""

import os
import re

import pytest

import corpus_pipeline
from adtally.llm import quality, simhash

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_stages_and_their_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, None
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "personal_data", "target_mix", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, SF).checkpoint()
        assert docs.columns == columns
        now = [r.doc_id for r in docs.collect()]
        assert len(now) == len(set(now)) and (ids is None or set(now) <= ids)
        if name == "quality_rules":
            judged = quality.judge(docs, quality.DecisionList()).collect()
            assert not any(r.base_failed for r in judged)
        if name == "near_duplicates":
            again = simhash.near_duplicates(docs).collect()
            assert all(r.doc_id == r.component_id for r in again)
            groups = {r.component_id for r in simhash.near_duplicates(before).collect()}
            assert groups == set(now)
        if name == "personal_data":
            assert len(now) == before.count()
            assert not any(re.search(r"[a-z0-9]@mail", r.text) for r in docs.collect())
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        ids = set(now)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == ids


def test_run_gives_pieces(spark):
    pieces = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(pieces.columns)
    assert pieces.count() > 0


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, kept string, places int"


def odd_rows():
    good = "This is a plain page about the garden and the weather, with some more words to read. " * 4
    rows = [(1, None, None, None, None), (2, "", "en", "web", 0), (None, good, "en", None, 3), (3, "   \n", None, "web", 4)]
    rows += [(4, good, "en", "web", 5)] * 3 + [(5, "mail a@b.co " + good, "en", "web", 5), (6, "word " * 200_000, "en", "web", 7)]
    rows += [(10 + i, f"{good} {i} {i * 7} other ending number {i}", "en", "books", 9) for i in range(8)]
    return [(*r, 1, "x", 2) for r in rows]


@pytest.mark.parametrize("rows", [odd_rows(), []], ids=["odd", "empty"])
def test_every_stage_on_odd_rows(spark, rows):
    """Nulls, empty and long texts, repeated rows, other columns of names used within, and no rows at all."""
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == corpus_pipeline.COLUMNS
        found = out.collect()
        given = [r.doc_id for r in docs.collect()]
        assert all(r.doc_id in given for r in found)
        if name == "personal_data":
            assert len(found) == len(given) and not any("a@b.co" in (r.text or "") for r in found)
        if name == "near_duplicates":
            assert len({r.doc_id for r in found}) == len(found)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == {r[0] for r in rows}
